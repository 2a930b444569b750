"""Cross-tokenizer alignment: groups of tokens that two tokenizers cut alike.

Tokens of A and B cover the same bytes.  Every token points to the
farthest-right token that overlaps it; successors are doubled (all at once, in
numpy) until they stop changing, and each chain ends at the terminal token of
its component: a token of B that ends where one of A does.  The terminals label
the groups.

Neither tokenizer joins a blank to the character before it, so texts are first
cut before blanks that follow no white space; equal stretches of a block of
texts are encoded and aligned once.  Both facts are checked against the bytes:
a text whose tokens do not give its bytes back has no tokens.

Id pairs are counted over the corpus in two steps: a block of texts (about
``BLOCK`` bytes) combines its own texts' pairs, and the blocks' counts are
summed by pair.  Each block then gets the counts of its own pairs back by a
join, one row a pair and block and not one a link, and sums them for its
texts.  No pair, however frequent, has more rows than there are blocks; the
best count of an A id is one row for each id of A's vocabulary.

Defined cases: null and empty texts, and texts whose tokens' bytes differ from
a blank and the text, have zeros and an empty ``groups_sha256``; rows that share
an id, or have none, are documents of their own; a very long text is a block of
its own; an empty table gives no rows.  Other columns of the table are left out,
whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import pieces
from ledgerloom.llm.common import columns_of, cut, hand_out, here, prepare, small, table
from ledgerloom.session import ensure_checkpoint_dir

BLOCK = 4 << 20
#: Stretches of text handed to a tokenizer in one line, and lines at a time.
TOGETHER, LINES = 128, 64
#: Distinct stretches aligned at a time, and a block's stretches whose pairs are
#: looked at together (of whole texts): what a worker holds at once beside the
#: block's own results.
PARTS, AT_ONCE = 1 << 14, 1 << 16

_DOC = "doc_id: array<bigint>, n_a: array<bigint>, n_b: array<bigint>, n_groups: array<bigint>, n_links: array<bigint>, groups_sha256: array<string>"
_BLOCK = f"block bigint, key array<bigint>, n array<bigint>, docs struct<{_DOC}>, links binary"


def a_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def b_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """The two tokenizers, and the bytes of their tokens."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        unmap = {c: i for i, c in enumerate(pieces.byte_chars())}
        tokens = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for t, i in self.a.get_vocab(with_added_tokens=False).items():
            tokens[i] = bytes(unmap[c] for c in t)
        self.a_bytes = pa.array(tokens, pa.binary())
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        n = self.b.get_piece_size()
        name = self.b.id_to_piece
        self.b_bytes = pa.array([bytes([int(name(i)[3:5], 16)]) if self.b.is_byte(i) else name(i).replace("▁", " ").encode() for i in range(n)], pa.binary())
        self.blank = self.b.piece_to_id("▁")
        self.names = pa.array([str(i) for i in range(max(n, len(tokens)))])

    def a_ids(self, lines: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(lines, add_special_tokens=False)]

    def b_ids(self, lines: list[str]) -> list[np.ndarray]:
        """Of lines that begin with the blank which B adds itself."""
        made = self.b.encode([x[1:] for x in lines], num_threads=1)
        return [np.array(ids if len(x) > 1 else [self.blank], np.int64) for x, ids in zip(lines, made)]


def closed(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is surely no white space of
    any tokenizer's (some rare ones count as white space here)."""
    one = raw[at - 1]
    two, three = raw[np.maximum(at - 2, 0)], raw[np.maximum(at - 3, 0)]
    blank = (one <= 32) & ((one >= 28) | ((one >= 9) & (one <= 13)))
    blank |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    blank |= (three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A))
    return ~blank


def stretches(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """A blank and each (not empty) text, cut before blanks behind anything
    but white space: the coded stretches, and where each text's begin."""
    whole = pc.binary_join_element_wise("", texts, " ")
    ends = np.cumsum(pc.binary_length(whole).to_numpy().astype(np.int64))
    begins = np.concatenate([[0], ends])
    raw = np.frombuffer(pa.concat_arrays([whole]).buffers()[2], np.uint8)[:begins[-1]]
    at = np.flatnonzero(raw == 32)
    at = at[at > 0]
    at = at[closed(raw, at)]
    at = np.union1d(at, begins[:-1])
    parts = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, begins[-1]).astype(np.int32)), pa.py_buffer(raw)])
    return parts.dictionary_encode(), np.searchsorted(at, begins)


def encoded(parts: pa.Array, encode, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all stretches in order, the number of each one's, and which of
    them the tokens do not give back."""
    sizes = pc.binary_length(parts).to_numpy().astype(np.int64)
    raw = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts), "")[0].as_py().encode()
    ends = np.cumsum(sizes)
    shut = closed(np.frombuffer(raw, np.uint8), ends)
    # Lines of whole stretches; what ends in white space ends its line.
    last = np.flatnonzero(~shut | (np.arange(1, len(parts) + 1) % TOGETHER == 0) | (np.arange(1, len(parts) + 1) == len(parts)))
    cuts = np.concatenate([[0], ends[last]])
    lines = [raw[x:y].decode() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    ids = np.concatenate([np.zeros(0, np.int64), *(x for k in range(0, len(lines), LINES) for x in encode(lines[k:k + LINES]))])
    told = tokens.take(pa.array(ids))
    stops = np.cumsum(pc.binary_length(told).to_numpy().astype(np.int64))
    wrong = np.zeros(len(parts), bool)
    if told.buffers()[2] is None or bytes(told.buffers()[2])[:int(stops[-1])] != raw:
        # Some stretch is not given back: each for itself.
        made = encode(parts.to_pylist())
        for k, (x, own) in enumerate(zip(parts, made)):
            if b"".join(tokens.take(pa.array(own)).to_pylist()) != x.as_py().encode():
                wrong[k], made[k] = True, own[:0]
        return np.concatenate(made), np.array([len(x) for x in made]), wrong
    counts = np.diff(np.searchsorted(stops, ends, "left") + 1, prepend=0)
    return ids, counts, wrong


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The terminal token of B of every token's component: first A's tokens,
    then B's.  The ends ascend, and both cover the same bytes."""
    n = len(a_ends)
    over = np.searchsorted(a_ends, b_ends, "left")
    own = n + np.arange(len(b_ends))
    succ = np.concatenate([n + np.searchsorted(b_ends, a_ends, "left"), np.where(a_ends[over] > b_ends, over, own) if n else own])
    while True:
        twice = succ[succ]
        if np.array_equal(twice, succ):
            return succ - n
        succ = twice


def listed(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whole-number sums of consecutive runs."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Aligned:
    """The alignment of some distinct stretches: numbers of tokens, groups and
    links of each, its groups as text, and its id pairs (``key``: distinct
    pairs ``a * 2**32 + b``; ``pair``, ``times``: numbers of ``key`` and how
    often a stretch links them, ``pairs`` to a stretch)."""

    def __init__(self, aligner: Aligner, parts: pa.Array):
        a, n_a, bad_a = encoded(parts, aligner.a_ids, aligner.a_bytes)
        b, n_b, bad_b = encoded(parts, aligner.b_ids, aligner.b_bytes)
        self.wrong = bad_a | bad_b
        # What one of the two cannot give back goes in both.
        a, n_a = a[~np.repeat(self.wrong, n_a)], np.where(self.wrong, 0, n_a)
        b, n_b = b[~np.repeat(self.wrong, n_b)], np.where(self.wrong, 0, n_b)
        self.n_a, self.n_b = n_a, n_b
        size_a, size_b = (pc.binary_length(t).to_numpy().astype(np.int64) for t in (aligner.a_bytes, aligner.b_bytes))
        end = terminals(np.cumsum(size_a[a]), np.cumsum(size_b[b]))
        last = np.zeros(len(b) + 1, np.int64)
        last[end] = 1
        rank = np.cumsum(last) - 1  # of the groups, at their terminals
        group_a, group_b = rank[end[:len(a)]], rank[end[len(a):]]
        total = int(last.sum())
        of = np.repeat(np.arange(len(parts)), n_b)[np.flatnonzero(last[:len(b)])]  # the stretch of a group
        in_a, in_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
        self.n_groups = np.bincount(of, minlength=len(parts))
        self.n_links = sums(in_a * in_b, self.n_groups)
        left, right = (pc.binary_join(listed(aligner.names.take(pa.array(ids)), n), ",") for ids, n in ((a, in_a), (b, in_b)))
        self.text = pc.binary_join(listed(pc.binary_join_element_wise(left, right, "|"), self.n_groups), ";")
        # Distinct ids of a group on both sides, then their products.
        once_a, times_a = np.unique(group_a << 32 | a, return_counts=True)
        once_b, times_b = np.unique(group_b << 32 | b, return_counts=True)
        own_a, own_b = once_a >> 32, np.bincount(once_b >> 32, minlength=total)
        many = own_b[own_a]
        x = np.repeat(np.arange(len(once_a)), many)
        y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + np.repeat((np.cumsum(own_b) - own_b)[own_a], many)
        key = (once_a[x] & 0xFFFFFFFF) << 32 | (once_b[y] & 0xFFFFFFFF)
        self.key, self.pair = np.unique(key, return_inverse=True)
        self.pair = self.pair.astype(np.int32)
        self.times = times_a[x] * times_b[y]
        self.pairs = np.bincount(of[own_a[x]], minlength=len(parts))


class AllAligned:
    """``Aligned`` of any number of distinct stretches, made ``PARTS`` at a
    time."""

    def __init__(self, aligner: Aligner, parts: pa.Array):
        made = [Aligned(aligner, parts.slice(k, PARTS)) for k in range(0, len(parts), PARTS)]
        for name in ("wrong", "n_a", "n_b", "n_groups", "n_links", "times", "pairs"):
            setattr(self, name, np.concatenate([vars(m).pop(name) for m in made]))
        self.text = pa.concat_arrays([m.text for m in made])
        self.key = np.unique(np.concatenate([m.key for m in made]))
        self.pair = np.concatenate([np.searchsorted(self.key, m.key).astype(np.int32)[vars(m).pop("pair")] for m in made])


def _blob(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(y for x in arrays for y in (x.nbytes.to_bytes(8, "little"), x.data)))


def _arrays(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        size = int.from_bytes(raw[at:at + 8], "little")
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def _block(aligner: Aligner, ids: pa.Array, texts: pa.Array) -> tuple[pa.StructArray, np.ndarray, np.ndarray, bytes]:
    """A block's documents, its id pairs, how many documents hold each, and
    what is needed to sum the pairs' counts by document."""
    n = len(texts)
    on = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    coded, begins = stretches(texts.filter(pa.array(on))) if on.any() else (pa.array([""]).dictionary_encode().slice(0, 0), np.zeros(1, np.int64))
    words, counts = coded.indices.to_numpy().astype(np.int64), np.diff(begins)
    if not len(words):
        made = None
        words_of = np.zeros(n, np.int64)
    else:
        made = AllAligned(aligner, coded.dictionary)
        good = sums(made.wrong[words].astype(np.int64), counts) == 0
        words = words[np.repeat(good, counts)]
        words_of = np.zeros(n, np.int64)
        words_of[np.flatnonzero(on)[good]] = counts[good]
    if made is None or not len(words):
        zeros = pa.array(np.zeros(n, np.int64))
        docs = [ids, zeros, zeros, zeros, zeros, pa.array([""] * n)]
        return docs, np.zeros(0, np.int64), np.zeros(0, np.int64), _blob(words_of.astype("<u4"), *[np.zeros(0, "<u4")] * 3, np.zeros(0, "<i8"))
    shas, holders = [], np.zeros(len(made.key), np.int64)
    first_pair = np.cumsum(made.pairs) - made.pairs
    for start, stop, own in text_runs(words, words_of):
        lines = pc.binary_join(listed(made.text.take(pa.array(own)), words_of[start:stop]), ";")
        shas += [hashlib.sha256(x.as_buffer()).hexdigest() if k else "" for x, k in zip(lines, words_of[start:stop].tolist())]
        # How many documents hold each pair: once a document and stretch, then once a document and pair.
        held = np.unique(np.repeat(np.arange(stop - start), words_of[start:stop]) * len(made.pairs) + own)
        doc, word = held // len(made.pairs), held % len(made.pairs)
        many = made.pairs[word]
        at = np.repeat(first_pair[word] - (np.cumsum(many) - many), many)
        at += np.arange(len(at))
        at = made.pair[at].astype(np.int64)
        at += np.repeat(doc * len(made.key), many)
        at.sort()
        holders += np.bincount(at[np.flatnonzero(np.diff(at, prepend=-1))] % len(made.key), minlength=len(made.key))
    docs = [ids, *(pa.array(sums(v[words], words_of)) for v in (made.n_a, made.n_b, made.n_groups, made.n_links)), pa.array(shas, pa.string())]
    used = np.flatnonzero(holders)  # pairs of texts without tokens are none
    renamed = np.cumsum(holders > 0) - 1
    blob = _blob(words_of.astype("<u4"), words.astype("<u4"), made.pairs.astype("<u4"), renamed.astype("<i4")[made.pair].view("<u4"), made.times.astype("<i8"))
    return docs, made.key[used], holders[used], blob


def text_runs(words: np.ndarray, words_of: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of whole texts of about ``AT_ONCE`` stretches: the first text, the
    one behind the last, and their stretches."""
    ends = np.cumsum(words_of)
    start = 0
    while start < len(words_of):
        begin = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, begin + AT_ONCE, "right")))
        yield start, stop, words[begin:int(ends[stop - 1])]
        start = stop


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


def blocks(docs: DataFrame, a: str, b: str, size: int = BLOCK) -> DataFrame:
    """One row a block of texts, as ``_BLOCK`` says."""
    spark = prepare(docs.sparkSession)
    a, b = hand_out(spark, a), hand_out(spark, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(here(a), here(b))
        number = TaskContext.get().partitionId() << 32
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        for batch in batches:
            at = 0
            for texts in pieces.groups(batch.column("text"), size):
                made, key, n, links = _block(aligner, batch.column("doc_id").slice(at, len(texts)), texts)
                whole = np.array([len(texts)])
                docs = pa.StructArray.from_arrays([listed(x, whole) for x in made], names)
                one = np.array([len(key)])
                yield pa.RecordBatch.from_arrays([pa.array([number]), listed(pa.array(key), one), listed(pa.array(n.astype(np.int64)), one), docs, pa.array([links], pa.binary())],
                                                 ["block", "key", "n", "docs", "links"])
                del made, key, n, links, docs
                pieces.give_back()
                at, number = at + len(texts), number + 1

    return docs.mapInArrow(pieces.released(run), _BLOCK)


def pair_counts(held: DataFrame) -> DataFrame:
    """``key, n, best``: in how many documents an id pair is linked, and
    whether that is its A id's highest count.  ``held`` are written blocks."""
    each = held.select(F.inline(F.arrays_zip("key", "n")))
    counts = cut(each.groupBy("key").agg(F.sum("n").alias("n")))
    best = cut(counts.groupBy(F.shiftright("key", 32).alias("a")).agg(F.max("n").alias("top")))  # a row an id of A
    joined = counts.join(small(best), F.shiftright("key", 32) == F.col("a"))
    return joined.select("key", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``: the digest of every document's alignment, and
    ``a, b, n, best`` of every id pair."""
    spark = prepare(docs.sparkSession)
    d = columns_of(docs, {"doc_id": id_col, "text": text_col}).withColumn("doc_id", F.col("doc_id").cast("long"))
    out = os.path.join(ensure_checkpoint_dir(spark), f"aligned-{uuid.uuid4().hex}")
    blocks(d, a or a_path(), b or b_path(), size).write.parquet(out)
    held = spark.read.schema(_BLOCK).parquet(out)
    counts = cut(pair_counts(held))
    own = held.select("block", F.posexplode("key").alias("at", "key")).join(counts, "key")
    told = own.groupBy("block").agg(F.collect_list(F.struct("at", "n", "best")).alias("told"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words_of, words, pairs, pair, times = _arrays(batch.column("links")[k].as_py(), ["<u4", "<u4", "<u4", "<i4", "<i8"])
                row = batch.column("told")[k]
                n = best = np.zeros(1, np.int64)
                if row.is_valid:
                    at, n, best = (row.values.field(f).to_numpy(zero_copy_only=False) for f in ("at", "n", "best"))
                    order = np.argsort(at)
                    n, best = n[order], best[order].astype(np.int64)
                docs = batch.column("docs").slice(k, 1)
                fields = {f: docs.field(f).flatten() for f in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                for name, value in (("n_best", best), ("count_sum", n)):
                    by_word = sums(np.where(pair < 0, 0, value[np.maximum(pair, 0)]) * times, pairs.astype(np.int64))
                    fields[name] = pa.array(sums(by_word[words] if len(words) else np.zeros(0, np.int64), words_of.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(list(fields.values()), list(fields))

    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    documents = held.select("block", "docs", "links").join(told, "block", "left").select("docs", "links", "told").mapInArrow(pieces.released(run), kind)
    ids = counts.select(F.shiftright("key", 32).alias("a"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n", "best")
    return documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), ids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(prepare(spark), sf_dir, "documents"))[0]
