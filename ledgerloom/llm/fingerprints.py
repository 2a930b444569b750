"""Document fingerprints: improbable-feature digests in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy, scaled to 0..1000.  Over the
whole corpus the entropies are counted once; the rarer a window's entropy,
the better its rank (windows of nearly no entropy say nothing and have
none).  Within each stretch of ``WINDOW`` neighbouring windows the best
rank wins, the leftmost of equals; a window that wins at least ``POPULAR``
times is a feature.  Features go, in order, into a chain of Bloom filters
of ``BITS`` bits, ``PER_FILTER`` features each.

Two digests are compared filter by filter: each filter of the shorter chain
takes its best overlap in the other chain, normalised so that the overlap
expected by chance is 0 and containment is 1; the likeness is their mean,
weighted by set bits.

For comparison with the next document, rows are dealt by ranges of their id
(bounds are quantiles, at most one a partition) and each range's first row
travels once more, to the end of the range before it: one shuffle, no
global window, one text at a time in memory besides a group of about
``GROUP`` characters.

Windows are short enough that a text of a hundred characters has several
features: texts of all lengths are treated alike, and a text shares features
with what is left of it when a part is cut off.

Defined cases: null text is empty and has no features; a text without an
improbable window (or shorter than one) has its first bytes as a feature; two empty digests have likeness 1, an empty and
another one 0; equal texts have equal fingerprints wherever they stand;
rows of equal ids are ordered by text; rows without an id come last; a
single row is its own next; an empty table gives no rows; other columns are
left out, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, partitions, prepare, range_bounds, table

WINDOW, POPULAR, WEAK = 16, 2, 100
BITS, PER_FILTER, HASHES = 2048, 160, 5
GROUP = 1 << 19
_STRIDE = 1 << 18
_PAD = 0xFF  # never a byte of UTF-8
_NONE = 1023  # the rank of windows that cannot be features
_SCALE = 1 << 32
_C = np.arange(WINDOW + 1)
#: c * log2(c) as an integer, and what one more of a kind adds to it.
_CLOG = np.rint(_C * np.log2(np.maximum(_C, 1)) * _SCALE).astype(np.int64)
_STEP = np.diff(_CLOG, prepend=0)
_STEP[0] = 0
_FULL = int(_CLOG[WINDOW])  # all bytes differ


def _scores(raw: np.ndarray) -> np.ndarray:
    """Entropy of each window of ``raw``, 0..1000; -1 over padding."""
    n = len(raw) - WINDOW + 1
    seen = np.ones(len(raw), np.uint8)  # equal bytes among the last WINDOW
    ahead = np.ones(len(raw), np.uint8)  # equal bytes among the next WINDOW
    for lag in range(1, WINDOW):
        equal = (raw[lag:] == raw[:-lag]).view(np.uint8)
        seen[lag:] += equal
        ahead[:-lag] += equal
    total = np.empty(n, np.int64)
    total[0] = _CLOG[np.bincount(raw[:WINDOW], minlength=256)].sum()
    # A window loses its first byte, then gains the next one.
    total[1:] = total[0] + np.cumsum(_STEP[seen[WINDOW:]] - _STEP[ahead[:n - 1]])
    score = (1000 * ((_FULL - total) >> 16)) // (_FULL >> 16)
    pads = np.concatenate([[0], np.cumsum(raw == _PAD, dtype=np.int32)])
    score[pads[WINDOW:] > pads[:n]] = -1
    return score


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts between stretches of padding, and where each begins."""
    gap = bytes([_PAD]) * (2 * WINDOW)
    begins = np.cumsum([2 * WINDOW + len(t) for t in texts]) - np.array([len(t) for t in texts])
    return np.frombuffer(gap + gap.join(texts) + gap, np.uint8), begins


def _popular(raw: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Starts of the windows that win often enough, ascending."""
    wins = np.zeros(len(raw), np.uint8)
    for at in range(0, len(raw) - 2 * WINDOW + 2, _STRIDE):
        part = raw[at:at + _STRIDE + 2 * WINDOW - 2]
        r = rank[_scores(part)].astype(np.uint32)
        key = (r << np.uint32(20)) | np.arange(len(r), dtype=np.uint32)
        span = 1
        while span < WINDOW:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        key = key[(key >> np.uint32(20)) < _NONE]
        won = np.bincount(key & np.uint32((1 << 20) - 1), minlength=len(part))[:len(part)]
        wins[at:at + len(part)] += won.astype(np.uint8)
    return np.flatnonzero(wins >= POPULAR)


def features(texts: list[str], rank: np.ndarray) -> list[list[bytes]]:
    """The distinct features of each text, in order."""
    raws = [t.encode() for t in texts]
    raw, begins = _padded(raws)
    found = _popular(raw, rank)
    edges = np.searchsorted(found, begins), np.searchsorted(found, np.r_[begins[1:], len(raw)])
    whole = raw.tobytes()
    out = []
    for r, a, b in zip(raws, *edges):
        own = [whole[s:s + WINDOW] for s in found[a:b].tolist()] or [r[:WINDOW]]
        out.append(list(dict.fromkeys(own)) if r else [])
    return out


def digest(own: list[bytes]) -> np.ndarray:
    """Chained Bloom filters of a text's features: filters x bytes."""
    from xxhash import xxh3_64_intdigest

    if not own:
        return np.zeros((0, BITS // 8), np.uint8)
    h = np.array([xxh3_64_intdigest(f) for f in own], np.uint64)
    bits = np.zeros((-(-len(own) // PER_FILTER), BITS), bool)
    row = np.arange(len(own)) // PER_FILTER
    for k in range(HASHES):
        bits[row, (h >> np.uint64(11 * k)).astype(np.int64) & (BITS - 1)] = True
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    x, y = a.view(np.uint64), b.view(np.uint64)
    sx, sy = (np.bitwise_count(v).sum(1, dtype=np.int64) for v in (x, y))
    best = np.zeros(len(x))
    step = max(1, (1 << 16) // len(y))
    for at in range(0, len(x), step):
        common = np.bitwise_count(x[at:at + step, None] & y[None]).sum(2, dtype=np.int64)
        chance = sx[at:at + step, None] * sy[None] / BITS
        most = np.minimum(sx[at:at + step, None], sy[None])
        best[at:at + step] = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(1)
    return float((best * sx).sum() / sx.sum())


def as_text(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)


def entropy_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each entropy 0..1000 occurs among all windows of all
    texts (1,001 sums, whatever the input)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1001, np.int64)
        for b in batches:
            for group in _groups(t.as_py() for t in b.column(0)):
                raw, _ = _padded([t.encode() for t in group])
                for at in range(0, len(raw) - WINDOW + 1, _STRIDE):
                    s = _scores(raw[at:at + _STRIDE + WINDOW - 1])
                    total += np.bincount(s[s >= 0], minlength=1001)
        yield pa.RecordBatch.from_arrays([pa.array(range(1001), pa.int32()), pa.array(total)], ["entropy", "n"])

    rows = docs.select(docs[text_col].alias("text")).mapInArrow(run, "entropy int, n long").groupBy("entropy").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1001, np.int64)
    for r in rows:
        out[r["entropy"]] = r["n"]
    return out


def _groups(texts) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t or "")
        size += len(group[-1])
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy: the rarer the better (of equals, the higher
    entropy); the last place stands for windows without one."""
    order = sorted(range(WEAK, 1001), key=lambda e: (counts[e], -e))
    out = np.full(1002, _NONE, np.int64)
    out[order] = np.arange(len(order))
    return out


def fingerprint(texts: list[str | None], rank: np.ndarray) -> list[np.ndarray]:
    return [digest(f) for f in features([t or "" for t in texts], rank)]


def edited(text: str, following: str) -> str:
    """The last third replaced by the beginning of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness to
    each other and to the next document's, by descending id."""
    spark = prepare(docs.sparkSession)
    d = columns_of(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rank = ranks(entropy_counts(d))
    parts = partitions(spark)
    top, nulls = d.agg(F.max("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    # Range i holds the ids up to its head heads[i] and above the next one;
    # rows without an id follow in a range of their own.
    heads = sorted({top, *range_bounds(d, "doc_id", parts)} - {None}, reverse=True)
    ranges = len(heads) + (nulls > 0)
    if not ranges:
        return spark.createDataFrame([], RESULT)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up = np.array(heads[::-1], np.int64)
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            # The least head that is not below the id.
            own = np.array([len(heads) if i is None else len(heads) - 1 - int(np.searchsorted(up, i, "left")) for i in ids], np.int64)
            first = [k for k, (i, r) in enumerate(zip(ids, own.tolist())) if i is None or i == heads[r]]
            if own.size:
                where = np.r_[own, (own[first] - 1) % ranges]
                take = pa.array(np.r_[np.arange(len(ids)), first].astype(np.int64))
                tail = np.r_[np.zeros(len(ids), np.int32), np.ones(len(first), np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(tail.astype(np.int32)), b.column("doc_id").take(take), b.column("text").take(take)], ["part", "tail", "doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list, following: str):
            texts = [t for _, t in rows]
            after = [*texts[1:], following]
            changed = [edited(t, n) for t, n in zip(texts, after)]
            prints = fingerprint([*texts, following, *changed], rank)
            own, other = prints[:len(rows) + 1], prints[len(rows) + 1:]
            columns = [
                pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
                pa.array([as_text(p) for p in own[:-1]], pa.string()), pa.array([as_text(p) for p in other], pa.string()),
                pa.array([likeness(p, q) for p, q in zip(own, other)], pa.float64()), pa.array([likeness(p, q) for p, q in zip(own, own[1:])], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

        part, rows, size, ended = None, [], 0, False
        for b in batches:
            for p, tail, i, text in zip(b.column("part").to_pylist(), b.column("tail").to_pylist(), b.column("doc_id").to_pylist(), b.column("text")):
                if p != part:
                    part, rows, size, ended = p, [], 0, False
                if ended:
                    continue  # rows that share the head's id
                text = text.as_py()
                if tail or size >= GROUP:
                    if rows:
                        yield done(rows, text)
                    rows, size, ended = [], 0, bool(tail)
                if not tail:
                    rows.append((i, text))
                    size += len(text)

    order = ["part", "tail", F.col("doc_id").desc_nulls_last(), "text"]
    rows = d.mapInArrow(deal, "part int, tail int, doc_id long, text string").repartitionById(ranges, "part").sortWithinPartitions(*order)
    return rows.mapInArrow(run, RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    return compare(table(prepare(spark), sf_dir, "documents"))
