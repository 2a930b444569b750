"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The frequent words of the corpus (counted over all documents) are compiled
with their token ids into a minimal acyclic transducer: words share
prefixes and suffixes, and integers summed along a path give the word's
number, which finds its ids.  The automaton is one flat file that Spark
hands to every executor once and workers memory-map.  Other words are merged
exactly by the vocabulary's merge ranks.  The lexicon only saves time; ids
never depend on it.

Texts are cut at ASCII blanks first: the tokenizer drops white space, and
its normaliser, special tokens and word pattern never look across it.  The
distinct words of a group of texts (see ``pieces``) step through the automaton
together; those it lacks are merged together, in numpy, and remembered within
bounds.  Pieces beyond ASCII and plain Latin letters take their words from the
tokenizers library's own normaliser and pre-tokenizer.

Defined cases: null text is empty; an empty text has no ids and decodes to
an empty text; special tokens in a text encode to their ids; repeated rows
give repeated results; rows without an id are encoded like any other; very long
texts are encoded in parts and very long words in n log n; an empty table gives
no rows; other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.files import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import pieces
from ledgerloom.llm.common import columns_of, cut, hand_out, here, prepare, table

#: Words compiled into the lexicon: the most frequent ones (a size, not a
#: sample: the counts cover all documents).
LEXICON_WORDS = 1 << 16
#: Distinct words that a worker counts before it passes the counts on.
MEMO = 300_000
#: Words merged at a time; longer ones than ``WIDE`` bytes are merged alone.
TOGETHER, WIDE = 1 << 14, 32

_PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-įı-ſ]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\x20\x09-\x0da-zß-öø-ſ0-9]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_byte_chars = pieces.byte_chars


class Vocabulary:
    """Ids, merges and word rules of a tokenizer file of the kind
    ``word_bpe_49k.json`` (byte-level BPE with a word-end suffix)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        chars = _byte_chars()
        self.inner = [vocab[c] for c in chars]
        self.final = [vocab[c + suffix] for c in chars]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self._merge_tables()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens, self.names = [b""] * size, None
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t.encode()

    def _merge_tables(self) -> None:
        """The merges as sorted arrays, and directly by the two parts where
        both are single bytes."""
        pairs = np.array([(a << 32) | b for a, b in self.merges], np.int64)
        ranks, made = (np.array([m[k] for m in self.merges.values()], np.int64) for k in (0, 1))
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], ranks[order]
        self.made = np.zeros(int(ranks.max(initial=0)) + 1, np.int64)
        self.made[ranks] = made
        self.byte_ids = np.array([self.inner, self.final], np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of merging each a with its b; ``NEVER`` if they do not."""
        pair = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], NEVER)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many words, as ``<u4`` bytes: in each round every word
        makes its best merge, the leftmost of equal ones."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        for at in range(0, len(order), TOGETHER):
            own = order[at:at + TOGETHER]
            for k in own[sizes[own] > WIDE].tolist():
                out[k] = np.array(self.merge(words[k].decode()), "<u4").tobytes()
            own = own[(sizes[own] <= WIDE) & (sizes[own] > 0)]
            if len(own):
                ids, n = self._merge_block([words[k] for k in own.tolist()], sizes[own])
                ends = np.cumsum(n) * 4
                raw = ids[np.arange(ids.shape[1]) < n[:, None]].astype("<u4").tobytes()
                for k, a, z in zip(own.tolist(), (ends - 4 * n).tolist(), ends.tolist()):
                    out[k] = raw[a:z]
        return out

    def _merge_block(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = int(sizes.max())
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
        column = np.arange(width)
        ids = np.where(column == sizes[:, None] - 1, self.byte_ids[1][raw], self.byte_ids[0][raw])
        ids[column >= sizes[:, None]] = 0
        left = sizes.copy()
        rank = np.full(ids.shape, NEVER)
        if width > 1:
            on = column[1:] < sizes[:, None]
            rank[:, :-1][on] = self.ranks_of(ids[:, :-1][on], ids[:, 1:][on])
        go = np.flatnonzero(rank.min(1) < NEVER)
        while len(go):
            at = rank[go].argmin(1)
            ids[go, at] = self.made[rank[go, at]]
            # What stands behind the merged pair moves up.
            behind = column > at[:, None]
            for table, fill in ((ids, 0), (rank, NEVER)):
                rows = table[go]
                moved = np.concatenate([rows[:, 1:], np.full((len(go), 1), fill)], axis=1)
                table[go] = np.where(behind, moved, rows)
            left[go] -= 1
            last = at == left[go] - 1
            rank[go[last], at[last]] = NEVER
            some, i = go[~last], at[~last]
            rank[some, i] = self.ranks_of(ids[some, i], ids[some, i + 1])
            some, i = go[at > 0], at[at > 0]
            rank[some, i - 1] = self.ranks_of(ids[some, i - 1], ids[some, i])
            go = go[rank[go].min(1) < NEVER]
        return ids, left

    def words(self, piece: str) -> list[str | int]:
        """The words of a text piece without blanks at which the tokenizer
        merges, and the ids of special tokens between them."""
        out: list[str | int] = []
        parts = self._special.split(piece) if self._special and "<" in piece else [piece]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
            elif _PLAIN.fullmatch(part):
                out += _WORDS.findall(part.lower())
            else:
                seen = self.library.normalizer.normalize_str(part)
                chars = self.library.pre_tokenizer.pre_tokenize_str(seen)
                out += [_unmap(w) for w, _ in chars]
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one word by the merge ranks alone."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        if len(ids) > 64:
            return self._merge_long(ids)
        merges = self.merges
        while len(ids) > 1:
            found = [m for m in map(merges.get, zip(ids, ids[1:])) if m]
            if not found:
                break
            rank, new = min(found)
            out, i, last = [], 0, len(ids) - 1
            while i <= last:
                if i < last and (m := merges.get((ids[i], ids[i + 1]))) and m[0] == rank:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for a word of any length, in n log n."""
        n, merges = len(ids), self.merges
        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            if not live[i] or ids[i] != a or (j := nxt[i]) >= n or ids[j] != b:
                continue
            ids[i], live[j], nxt[i] = new, False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if m := merges.get((new, ids[nxt[i]])):
                    heapq.heappush(heap, (m[0], i, new, ids[nxt[i]], m[1]))
            if prv[i] >= 0 and (m := merges.get((ids[prv[i]], new))):
                heapq.heappush(heap, (m[0], prv[i], ids[prv[i]], new, m[1]))
        return [x for x, on in zip(ids, live) if on]

    def decode(self, ids: np.ndarray) -> bytes:
        """As the library's ``decode(ids, skip_special_tokens=False)``."""
        if self.library.decoder is not None:
            return self.library.decode(ids.tolist(), skip_special_tokens=False).encode()
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts that consecutive runs of ids decode to."""
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        if self.library.decoder is not None:
            return pa.array([self.decode(ids[a:z]).decode() for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.string())
        if self.names is None:
            self.names = pa.array([t.decode() for t in self.tokens], pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.names.take(pa.array(ids))), " ")


#: The rank of what is never merged.
NEVER = np.int64(1 << 40)
_UNMAP = {c: b for b, c in enumerate(_byte_chars())}


def _unmap(chars: str) -> str:
    return bytes(_UNMAP[c] for c in chars).decode()


class Lexicon:
    """Minimal acyclic transducer from words (bytes) to id sequences."""

    ARRAYS = ("keys", "target", "skip", "final", "starts", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, entries: Iterable[tuple[bytes, list[int]]]) -> Lexicon:
        """Built word by word in byte order: the branch that a new word
        leaves behind is finished, and merged with an equal state if one
        exists (equal finality and equal transitions)."""
        entries = sorted(dict(entries).items())
        registry: dict[tuple, int] = {}
        edges: list[list[tuple[int, int]]] = []
        finals: list[bool] = []
        counts: list[int] = []
        path: list[tuple[list, list]] = [([], [False])]  # (transitions, [final]) along the last word

        def finish(node) -> int:
            key = (node[1][0], tuple(node[0]))
            if key not in registry:
                registry[key] = len(edges)
                edges.append(node[0])
                finals.append(node[1][0])
                counts.append(node[1][0] + sum(counts[t] for _, t in node[0]))
            return registry[key]

        last = b""
        for word, _ in entries:
            keep = len(os.path.commonprefix([last, word]))
            while len(path) > keep + 1:
                node = path.pop()
                path[-1][0].append((last[len(path) - 1], finish(node)))
            for _ in word[keep:]:
                path.append(([], [False]))
            path[-1][1][0] = True
            last = word
        while len(path) > 1:
            node = path.pop()
            path[-1][0].append((last[len(path) - 1], finish(node)))
        root = finish(path[0])
        keys, target, skip = [], [], []
        # The root becomes state 0; a transition's skip counts the words
        # that come before it at its state.
        number = {root: 0} | {s: i + (i < root) for i, s in enumerate(range(len(edges))) if s != root}
        for s in sorted(range(len(edges)), key=number.__getitem__):
            passed = int(finals[s])
            for byte, t in sorted(edges[s]):
                keys.append(number[s] * 256 + byte)
                target.append(number[t])
                skip.append(passed)
                passed += counts[t]
        final = np.zeros(len(edges), np.uint8)
        for s, f in enumerate(finals):
            final[number[s]] = f
        lengths = [len(ids) for _, ids in entries]
        return cls({
            "keys": np.array(keys, np.int64), "target": np.array(target, np.int64), "skip": np.array(skip, np.int64), "final": final,
            "starts": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), "ids": np.array([i for _, ids in entries for i in ids], np.uint32),
        })

    def save(self, path: str) -> None:
        head = {n: [str(getattr(self, n).dtype), len(getattr(self, n))] for n in self.ARRAYS}
        text = json.dumps(head).encode()
        with open(path, "wb") as f:
            f.write(len(text).to_bytes(8, "little") + text + b" " * (-len(text) % 8))
            for n in self.ARRAYS:
                raw = getattr(self, n).tobytes()
                f.write(raw + b"\0" * (-len(raw) % 8))

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """The arrays of a saved lexicon, memory-mapped."""
        whole = np.memmap(path, np.uint8, "r")
        n = int.from_bytes(whole[:8].tobytes(), "little")
        head = json.loads(whole[8:8 + n].tobytes())
        at, arrays = 8 + n + (-n % 8), {}
        for name, (kind, count) in head.items():
            size = np.dtype(kind).itemsize * count
            arrays[name] = whole[at:at + size].view(kind)
            at += size + (-size % 8)
        return cls(arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the lexicon, or -1."""
        return self.find_all(pa.array(words, pa.binary()))

    def find_all(self, words: pa.Array) -> np.ndarray:
        """The same for an Arrow column; all words step through the
        automaton together."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        words = pa.concat_arrays([words])  # without an offset
        places, buffer = np.frombuffer(words.buffers()[1], np.int32, n + 1), words.buffers()[2]
        buffer = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(1, np.uint8)
        lengths = np.diff(places)
        order = np.argsort(-lengths, kind="stable")
        ends, begins = lengths[order], places[:-1][order].astype(np.int64)
        state, number, alive = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
        for step in range(int(ends[0])):
            on = int(np.searchsorted(-ends, -step, "left"))  # words longer than step come first
            go = np.flatnonzero(alive[:on])
            if not len(go):
                break
            key = state[go] * 256 + buffer[begins[go] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive[go[~hit]] = False
            go, at = go[hit], at[hit]
            number[go] += self.skip[at]
            state[go] = self.target[at]
        good = alive & (self.final[state] > 0)
        out[order[good]] = number[good]
        return out


class Encoder(pieces.Encoder):
    """Encodes distinct words through the lexicon, then by merging."""

    def __init__(self, path: str, lexicon: Lexicon | None = None):
        self.vocabulary, self.lexicon = Vocabulary(path), lexicon
        self.known = pieces.Known()
        self.starts = np.asarray(lexicon.starts) if lexicon else np.zeros(1, np.int64)
        self.ids = np.asarray(lexicon.ids) if lexicon else np.zeros(0, "<u4")

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        number = self.lexicon.find_all(words) if self.lexicon else np.full(len(words), -1)
        new = number < 0
        lens, ids = self.known.ids_of(words.filter(pa.array(new)), self._merged) if new.any() else (np.zeros(0, np.int64), np.zeros(0, "<u4"))
        # The lexicon's runs first, then the merged ones.
        sizes = np.concatenate([np.diff(self.starts), lens])
        place = number.copy()
        place[new] = len(self.starts) - 1 + np.arange(len(lens))
        return sizes[place], pieces.gather(sizes, np.concatenate([self.ids, ids]).astype("<u4"), place)

    def _merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = self.vocabulary.merge_all(words.cast(pa.binary()).to_pylist())
        return np.array([len(x) // 4 for x in made], np.int64), np.frombuffer(b"".join(made), "<u4")

    def piece_ids(self, odd: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.vocabulary.words(p) for p in odd.to_pylist()]
        flat = [w for ws in parts for w in ws]
        on = np.array([isinstance(w, str) for w in flat], bool)
        coded = pa.array([w for w in flat if isinstance(w, str)], pa.string()).dictionary_encode()
        sizes, ids = self.word_ids(coded.dictionary)
        # Special tokens are runs of one id behind those of the words.
        special = np.array([w for w in flat if not isinstance(w, str)], "<u4")
        place = np.zeros(len(flat), np.int64)
        place[on] = coded.indices.to_numpy()
        place[~on] = len(sizes) + np.arange(len(special))
        sizes = np.concatenate([sizes, np.ones(len(special), np.int64)])
        data = pieces.gather(sizes, np.concatenate([ids, special]).astype("<u4"), place)
        counts = np.array([len(ws) for ws in parts], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[place])])
        stops = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(ends[stops]), data


def word_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``word, n`` over all whole texts; counted in the workers first."""

    name = hand_out(prepare(docs.sparkSession), path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(here(name), None).vocabulary
        held = pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        for b in batches:
            for group in pieces.groups(b.column(0)):
                held = pa.concat_tables([held, _counted(vocabulary, group)]).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
                if len(held) > MEMO:
                    yield from held.to_batches(100_000)
                    held = held.slice(0, 0)
        yield from held.combine_chunks().to_batches(100_000)

    counts = docs.select(docs[text_col].alias("text")).mapInArrow(pieces.released(run), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(vocabulary: Vocabulary, texts: pa.Array) -> pa.Table:
    """The words of a group of texts, counted."""
    units = pieces.Units(texts)
    often = np.bincount(units.pieces, minlength=len(units.pair))
    n = np.bincount(units.pair.ravel(), np.repeat(often, 2)).astype(np.int64) if len(units.pair) else np.zeros(1, np.int64)
    plain = units.words.to_pylist() + units.tails.to_pylist()
    words = Counter()
    for piece, k in zip(units.odd.to_pylist(), n[1 + len(plain):].tolist()):
        for w in vocabulary.words(piece):
            if isinstance(w, str):
                words[w] += k
    made = [pa.concat_arrays([units.words, units.tails, pa.array(list(words), pa.string())]), pa.array(np.concatenate([n[1:1 + len(plain)], np.array(list(words.values()), np.int64)]))]
    table = pa.table(made, ["word", "n"])
    return table.filter(pc.greater(pc.binary_length(table["word"]), 0))


_HANDED_OUT: set[tuple[str, str]] = set()


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS, text_col: str = "text") -> str:
    """Compile the corpus's most frequent words; returns the name under
    which every executor has the file (at most ``words`` entries, a few MB).

    No sort: a histogram of the counts (under 3,000 steps, whatever the
    corpus) gives the least step above which at most ``words`` words lie."""
    spark = prepare(docs.sparkSession)
    # Exact steps up to 1,024, then 32 to a doubling.
    step = F.when(F.col("n") <= 1024, F.col("n")).otherwise(704 + F.floor(F.log2("n") * 32)).cast("int")
    counts = cut(word_counts(docs, path, text_col).where("n > 1").withColumn("step", step))
    above, least = 0, None
    for r in sorted(counts.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        above += r["count"]
        if above > words:
            break
        least = r["step"]
    top = counts.where(F.col("step") >= (least if least is not None else 1 << 30))
    vocabulary = Vocabulary(path)
    lexicon = Lexicon.compile([(r["word"].encode(), vocabulary.merge(r["word"])) for r in top.collect()])
    folder = tempfile.mkdtemp(prefix="ledgerloom-lexicon-")
    local = os.path.join(folder, "lexicon.bin")
    lexicon.save(local)
    with open(local, "rb") as f:
        name = f"lexicon-{hashlib.sha256(f.read()).hexdigest()[:24]}.bin"
    sc = spark.sparkContext
    if (sc.applicationId, name) not in _HANDED_OUT:  # else an equal lexicon is there already
        os.rename(local, os.path.join(folder, name))
        sc.addFile(os.path.join(folder, name))
        _HANDED_OUT.add((sc.applicationId, name))
    return name


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, name: str | None) -> Encoder:
    """One encoder a worker process, kept over its tasks."""
    if (path, name) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, name] = Encoder(path, Lexicon.open(SparkFiles.get(name)) if name else None)
    return _ENCODERS[path, name]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit integers) and
    ``decoded``, the text those ids decode to."""
    path = path or default_path()
    d = columns_of(docs, {"doc_id": id_col, "text": text_col})
    name = build_lexicon(d, path, words)
    kind = d.schema["doc_id"].dataType.simpleString()

    def columns(ids, counts, told):
        return [pieces.binary_column(ids, counts), told]

    return d.mapInArrow(_mapper(hand_out(docs.sparkSession, path), name, columns, ["ids", "decoded"]), f"doc_id {kind}, ids binary, decoded string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``encode``'s
    outputs, computed where they are made."""
    path = path or default_path()
    d = columns_of(docs, {"doc_id": id_col, "text": text_col})
    name = build_lexicon(d, path, words)
    kind = d.schema["doc_id"].dataType.simpleString()

    def columns(ids, counts, told):
        raw, ends = memoryview(np.ascontiguousarray(ids)).cast("B"), 4 * np.cumsum(counts)
        sums = [hashlib.sha256(raw[a:z]).hexdigest() for a, z in zip((ends - 4 * counts).tolist(), ends.tolist())]
        return [pa.array(counts, pa.int64()), pa.array(sums), pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in told])]

    return d.mapInArrow(_mapper(hand_out(docs.sparkSession, path), name, columns, ["n_tokens", "ids_sha256", "decoded_sha256"]),
                        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _mapper(path: str, name: str, columns, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(here(path), name)
        for b in batches:
            for at, ids, counts in encoder.batch_ids(b.column("text")):
                told = encoder.vocabulary.decode_all(ids, counts)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(counts)), *columns(ids, counts, told)], ["doc_id", *names])

    return pieces.released(run)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(prepare(spark), sf_dir, "documents"))
