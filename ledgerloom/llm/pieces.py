"""Token ids of whole Arrow batches, a distinct word at a time.

For tokenizers that drop white space and never look across it: texts are cut
at ASCII blanks, equal pieces of a group of texts fall into one by Arrow's
dictionary encoding, and a piece of plain Latin letters with punctuation
behind it gives a folded word and a tail, so one look-up serves a word in all
its guises.  Ids of distinct units are looked up, and gathered back to the
texts by numpy, never word by word.

A worker holds one group of texts, and remembers words as two flat columns
bounded in words and in bytes (the longest unused go first).  Ids never depend
on what is remembered.  Free memory goes back when a task ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in groups of about this many bytes; a longer one is cut at
#: blanks.
GROUP = 12 << 20
#: Remembered words: at most so many, of so many bytes with their ids; longer
#: ones than ``LONG`` are the first to go.
KNOWN, KNOWN_BYTES, LONG = 500_000, 24_000_000, 256

#: Latin letters whose lower case is one letter, and ASCII punctuation.
_GUISE = "^(?P<word>[A-Za-zÀ-ÖØ-öø-įı-ſ]+)(?P<tail>[!-/:-@\\[-`{-~]*)$"
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def groups(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """A batch's texts in stretches of about ``size`` bytes, null as empty."""
    size = size or GROUP
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(at, to - at)
        at = to


def stretches(raw: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts cut at blanks."""
    at = 0
    while len(raw) - at > size:
        m = _BLANK.search(raw, at + size)
        if not m:
            break
        yield raw[at:m.start()]
        at = m.end()
    yield raw[at:] if at else raw


def gather(lens: np.ndarray, data: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Runs of ``data`` with these lengths, picked by ``idx``, one after the
    other."""
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(data))
    return lists.take(pa.array(idx)).flatten().to_numpy()


class Known:
    """Distinct words with their ids, from one group to the next."""

    def __init__(self):
        self.words, self.lens, self.ids = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.used, self.now = np.zeros(0, np.int64), 0

    def ids_of(self, words: pa.Array, make) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of distinct words; ``make`` gives those
        of the words that are not known."""
        self.now += 1
        at = pc.index_in(words, value_set=self.words)
        new = pc.is_null(at)
        fresh = words.filter(new)
        lens, ids = make(fresh)
        place = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(fresh))
        self.words = pa.concat_arrays([self.words, fresh])
        self.lens, self.ids = np.concatenate([self.lens, lens]), np.concatenate([self.ids, ids])
        self.used = np.concatenate([self.used, np.zeros(len(fresh), np.int64)])
        self.used[place] = self.now
        out = self.lens[place], gather(self.lens, self.ids, place)
        self._bound()
        return out

    def _bound(self) -> None:
        size = pc.binary_length(self.words).to_numpy() + 4 * self.lens
        if len(size) <= KNOWN and int(size.sum()) <= KNOWN_BYTES:
            return
        order = np.argsort(-self.used, kind="stable")
        order = order[size[order] <= LONG]
        order = order[np.cumsum(size[order]) <= KNOWN_BYTES // 2][:KNOWN // 2]
        self.ids = gather(self.lens, self.ids, order)
        self.words, self.lens, self.used = self.words.take(pa.array(order)), self.lens[order], self.used[order]


class Units:
    """The distinct units of a group: ``names``, and for each piece of a
    text (``pieces``, in order; ``offsets`` by text) its word or whole piece
    and its tail as numbers of units.  Unit 0 is the empty one."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy()
        self.offsets = offsets - offsets[0]
        coded = lists.flatten().dictionary_encode()
        self.pieces = coded.indices.to_numpy(zero_copy_only=False)
        distinct = coded.dictionary
        guise = pc.extract_regex(distinct, _GUISE)
        plain = guise.is_valid()
        word = pc.utf8_lower(guise.field("word")).filter(plain).dictionary_encode()
        tail = guise.field("tail").filter(plain).dictionary_encode()
        odd = distinct.filter(pc.invert(plain))
        self.words, self.tails, self.odd = word.dictionary, tail.dictionary, odd
        on = plain.to_numpy(zero_copy_only=False)
        self.pair = np.zeros((len(distinct), 2), np.int64)
        self.pair[on, 0] = 1 + word.indices.to_numpy(zero_copy_only=False)
        self.pair[on, 1] = 1 + len(word.dictionary) + tail.indices.to_numpy(zero_copy_only=False)
        self.pair[~on, 0] = 1 + len(word.dictionary) + len(tail.dictionary) + np.arange(len(odd))

    def assemble(self, lens: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the runs of the units (the empty one first) to the runs of
        all texts in order, and the length of each text's."""
        flat = self.pair.ravel()
        data, lens = gather(lens, data, flat), lens[flat].reshape(-1, 2).sum(1)
        ends = np.concatenate([[0], np.cumsum(lens[self.pieces])])
        return gather(lens, data, self.pieces), np.diff(ends[self.offsets])


class Encoder:
    """Ids of texts; subclasses say how the distinct units get theirs."""

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of folded words of Latin letters."""
        raise NotImplementedError

    def piece_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of any other pieces without blanks."""
        raise NotImplementedError

    def unit_ids(self, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of the units, the empty one first."""
        made = [self.word_ids(units.words), self.piece_ids(pa.concat_arrays([units.tails, units.odd]))]
        return np.concatenate([[0], *(n for n, _ in made)]).astype(np.int64), np.concatenate([ids for _, ids in made]).astype("<u4")

    def group_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a group of texts in order, and how many each has."""
        if len(texts) == 1 and len(raw := texts[0].as_py().encode()) > GROUP:
            parts = [self.group_ids(pa.array([part.decode()])) for part in stretches(raw, GROUP // 2)] if _BLANK.search(raw, GROUP // 2) else []
            if len(parts) > 1:
                return np.concatenate([ids for ids, _ in parts]), sum(n for _, n in parts)
        units = Units(texts)
        return units.assemble(*self.unit_ids(units))

    def batch_ids(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By groups of a batch: the first text's place, the ids of the
        group, and the number of ids of each of its texts."""
        at = 0
        for group in groups(texts):
            ids, counts = self.group_ids(group)
            yield at, ids, counts
            at += len(group)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for _, ids, counts in self.batch_ids(pa.array(texts, pa.string())):
            ends = np.cumsum(counts)
            for a, b in zip((ends - counts).tolist(), ends.tolist()):
                yield ids[a:b].tobytes()


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids with the end id behind each."""
    if end_id is None:
        return ids, counts
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1


def binary_column(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary value a run: the run's numbers as they lie in memory."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * numbers.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


def give_back() -> None:
    """Return the process's free memory, Arrow's and the allocator's, to the
    system: a worker waits for its next task with what it holds."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(run):
    """A worker function over batches that gives its free memory back when
    its task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


#: Words of one call of the library.
_TOGETHER = 128


class LibraryEncoder(Encoder):
    """Distinct units encoded by the tokenizers library itself.  Words of
    plain letters go to the library's BPE model together, cut at blanks,
    since normaliser and word pattern leave them whole; each ends at its one
    token with the word-end suffix.  Anything else takes the library's full
    way."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.known = Known()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.chars = {b: c for b, c in enumerate(byte_chars()) if b != 32}
        suffix = self.library.model.end_of_word_suffix
        self.last = np.zeros(self.size, bool)
        self.last[[i for t, i in self.library.get_vocab(with_added_tokens=False).items() if suffix and t.endswith(suffix)]] = True

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.known.ids_of(words, self._new_words)

    def _new_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.append(np.arange(0, len(words), _TOGETHER), len(words)).astype(np.int32)
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " ").to_pylist() if len(words) else []
        lines = [x if x.isascii() else x.encode().decode("latin-1").translate(self.chars) for x in lines]
        ids = _joined(self.words.encode_batch_fast(lines, add_special_tokens=False))
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # a vocabulary without word ends
            return self.piece_ids(words)
        return np.diff(ends, prepend=0), ids

    def piece_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = []
        for at in range(0, len(pieces), 20_000):
            made += [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(pieces.slice(at, 20_000).to_pylist(), add_special_tokens=False)]
        return np.array([len(x) for x in made], np.int64), np.concatenate([np.zeros(0, "<u4"), *made])


def _joined(encoded) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<u4"), *(np.array(e.ids, "<u4") for e in encoded)])


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest for U+0100 and up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        if b in printable:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    """One encoder a worker process, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]
