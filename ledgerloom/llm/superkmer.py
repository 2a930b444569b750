"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words.  Its minimiser is the least hash of
its ``MINIMISER``-word runs, so equal windows share it.  Consecutive windows
with one minimiser form a super-k-mer; it travels as one packed string to
the minimiser's bucket, where sorting brings equal windows together and
gives each the least document that holds it.

What need not travel stays: a minimiser that occurs in one document only
cannot belong to a repeated window, so texts are first read for minimisers
alone (numbers, not strings) and only super-k-mers of shared ones are
packed; the texts that hold them travel once, compressed.  Equal packed
strings are combined in each task before the shuffle.  A super-k-mer of more
than ``LONGEST`` windows (one word a thousand times) travels in parts.  A bucket
of more than ``HOT`` windows (a passage in a third of all documents, seen with
as many different surroundings) is dealt on window by window, by a 128-bit
digest of the window, with map-side minima; it never meets in one task.  So no
task holds more than ``HOT`` windows, of at most ``WINDOW`` words each, at once.

Defined cases: a null text has no words; a null id is larger than any other
id; repeated rows and rows that share an id are one document (no window is
removed for its own id), each judged by its own text; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, cut, partitions, prepare, steady, table
from ledgerloom.llm.pieces import released

WINDOW, MINIMISER = 50, 8
#: Windows of a bucket that is sorted in one task, and of a packed string.
HOT, LONGEST = 20_000, 256
#: Packed strings are passed on in batches of about this many bytes.
BATCH = 1 << 22
#: Words hashed at a time; longer texts are read in overlapping stretches.
STRETCH = 200_000
_LAST = (1 << 63) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = []
        for base in (int(_ODD), pow(int(_ODD), -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0][:n], _POWERS[1][:n]


def _stretch(words: list[bytes], window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of a stretch of words: first window, number of windows,
    minimiser."""
    raw = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    blanks = np.flatnonzero(raw == 32)  # words hold no blanks
    begins = np.r_[0, blanks[:-1] + 1]
    up, down = _powers(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(raw * up[:len(raw)], dtype=np.uint64)])
    a, b = begins[:len(words) - size + 1], blanks[size - 1:]
    h = (sums[b] - sums[a]) * down[a]  # the hash of a run, wherever it stands
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    width = window - size + 1
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if width > span:
        h = np.minimum(h[:span - width], h[width - span:])
    cut_at = np.flatnonzero(h[1:] != h[:-1]) + 1
    first = np.r_[0, cut_at]
    return first, np.diff(np.r_[first, len(h)]), h[first]


def super_kmers(words: list[bytes], window: int = WINDOW, size: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser (signed) of each
    super-k-mer of a text.  A stretch's end, or its length, may cut one in
    parts; its windows keep their minimiser, so nothing is lost."""
    out = []
    for at in range(0, max(0, len(words) - window + 1), STRETCH):
        first, n, m = _stretch(words[at:at + STRETCH + window - 1], window, size)
        out.append((first + at, n, m.view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    first, n, m = (np.concatenate(x) for x in zip(*out))
    parts = -(-n // LONGEST)
    if len(parts) < parts.sum():
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, n, m = np.repeat(first, parts) + at * LONGEST, np.minimum(np.repeat(n, parts) - at * LONGEST, LONGEST), np.repeat(m, parts)
    return first, n, m


def _words(text: pa.Scalar) -> list[bytes]:
    return (text.as_py() or "").encode().split()


def minimisers(docs: DataFrame, window: int, size: int) -> DataFrame:
    """``m, d, th, first, n`` of every super-k-mer, without its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, rows = [], 0
            at = []

            def out():
                of = pa.array(np.repeat(at, [len(p[0]) for p in parts]))
                first, n, m = (np.concatenate([p[i] for p in parts]) for i in range(3))
                return pa.RecordBatch.from_arrays([pa.array(m), b.column("d").take(of), b.column("th").take(of), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))], ["m", "d", "th", "first", "n"])

            for i, t in enumerate(b.column("text")):
                found = super_kmers(_words(t), window, size)
                if len(found[0]):
                    parts.append(found)
                    at.append(i)
                    rows += len(found[0])
                if rows > 200_000:
                    yield out()
                    parts, at, rows = [], [], 0
            if rows:
                yield out()

    return docs.mapInArrow(run, "m long, d long, th long, first int, n int")


def compressed(docs: DataFrame) -> DataFrame:
    """``d, th, z``: the texts, compressed for the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = pa.array([press.compress((t.as_py() or "").encode()) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("d"), b.column("th"), z], ["d", "th", "z"])

    return docs.mapInArrow(run, "d long, th long, z binary")


def _packed_runs(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[list[tuple]]:
    """By stretches of documents, every super-k-mer as ``pid`` (the digest of
    its packed string), ``m, d, th, first, packed``."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    for b in batches:
        rows, size = [], 0
        for d, th, z, runs in zip(b.column("d").to_pylist(), b.column("th").to_pylist(), b.column("z"), b.column("runs")):
            words = press.decompress(z.as_py()).split()
            for first, n, m in zip(*(runs.values.field(f).to_pylist() for f in ("first", "n", "m"))):
                packed = b" ".join(words[first:first + n + window - 1])
                rows.append((hashlib.blake2b(packed, digest_size=16).digest(), m, d, th, first, packed))
                size += len(packed) + 200
                if size > BATCH:
                    yield rows
                    rows, size = [], 0
        if rows:
            yield rows


def _pack(docs: DataFrame, window: int) -> DataFrame:
    """The super-k-mers as packed strings, equal ones of a stretch combined:
    ``pid, m, d`` (the least document) and ``packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _packed_runs(batches, window):
            least: dict[bytes, tuple] = {}
            for pid, m, d, _, _, packed in rows:
                if pid not in least or d < least[pid][1]:
                    least[pid] = (m, d, packed)
            columns = [list(least), *([v[k] for v in least.values()] for k in range(3))]
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["pid", "m", "d", "packed"])

    return docs.mapInArrow(released(steady(run)), "pid binary, m long, d long, packed binary")


def _occurrences(docs: DataFrame, window: int) -> DataFrame:
    """Where the super-k-mers stand: ``pid, d, th, first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _packed_runs(batches, window):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), *(pa.array([r[k] for r in rows], pa.int64()) for k in (2, 3, 4))], ["pid", "d", "th", "first"])

    return docs.mapInArrow(released(steady(run)), "pid binary, d long, th long, first long")


def _windows(packed: bytes, window: int) -> list[bytes]:
    raw = np.frombuffer(packed, np.uint8)
    blanks = np.flatnonzero(raw == 32)
    begins, ends = np.r_[0, blanks + 1], np.r_[blanks, len(raw)]
    return [packed[a:b] for a, b in zip(begins[:len(begins) - window + 1].tolist(), ends[window - 1:].tolist())]


def _sorted_buckets(packs: DataFrame, window: int) -> DataFrame:
    """``pid, least``: of each window of a packed string, the least document
    holding it, found by sorting the bucket's windows."""

    def bucket(rows):
        packs: dict[bytes, list] = {}
        for pid, d, packed in rows:
            held = packs.setdefault(pid, [d, packed])
            held[0] = min(held[0], d)
        spans = [_windows(packed, window) for _, packed in packs.values()]
        order = sorted((w, d, k, j) for k, ((d, _), ws) in enumerate(zip(packs.values(), spans)) for j, w in enumerate(ws))
        least = [[0] * len(ws) for ws in spans]
        last, low = None, 0
        for w, d, k, j in order:
            if w != last:
                last, low = w, d
            least[k][j] = low
        return list(zip(packs, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.list_(pa.int64()))], ["pid", "least"])

        for b in batches:
            done, held = [], 0
            for m, pid, d, packed in zip(b.column("m").to_pylist(), b.column("pid").to_pylist(), b.column("d").to_pylist(), b.column("packed")):
                if m != key:
                    if rows:
                        done += bucket(rows)
                        held += sum(len(x[1]) for x in done[-len(rows):])
                    key, rows = m, []
                    if held > 10 * HOT:
                        yield out(done)
                        done, held = [], 0
                rows.append((pid, d, packed.as_py()))
            if done:
                yield out(done)
        if rows:
            yield out(bucket(rows))

    n = partitions(packs.sparkSession)
    return packs.select("m", "pid", "d", "packed").repartition(n, "m").sortWithinPartitions("m").mapInArrow(released(steady(run)), "pid binary, least array<long>")


def _dealt_windows(packs: DataFrame, window: int) -> DataFrame:
    """The same for hot buckets, dealt by each window's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pid, d, packed in zip(b.column("pid").to_pylist(), b.column("d").to_pylist(), b.column("packed")):
                w = [hashlib.blake2b(x, digest_size=16).digest() for x in _windows(packed.as_py(), window)]
                n = len(w)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array([pid] * n, pa.binary()), pa.array(range(n), pa.int32()), pa.array([d] * n, pa.int64())], ["w", "pid", "j", "d"])

    each = packs.select("pid", "d", "packed").mapInArrow(run, "w binary, pid binary, j int, d long")
    least = each.groupBy("w").agg(F.min("d").alias("low"))
    back = each.select("w", "pid", "j").distinct().join(least, "w")
    return back.groupBy("pid").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "low"))), lambda x: x["low"]).alias("least"))


def _spans(hits: DataFrame) -> DataFrame:
    """Occurrences with their windows' least documents to the spans of
    windows that a smaller document holds too: ``d, th, lo, hi``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, th, first, least in zip(b.column("d").to_pylist(), b.column("th").to_pylist(), b.column("first").to_pylist(), b.column("least")):
                on = np.r_[False, least.values.to_numpy(zero_copy_only=False) < d, False]
                edge = np.flatnonzero(on[1:] != on[:-1])
                rows += [(d, th, first + lo, first + hi) for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["d", "th", "lo", "hi"])

    return hits.mapInArrow(run, "d long, th long, lo long, hi long")


def _whole(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, size: int = MINIMISER, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(keyed, removed)``: the documents as ``doc_id, d, th, text`` and,
    for those that lose words, ``d, th, z, spans``: the compressed text and
    the spans of removed windows."""
    prepare(docs.sparkSession)
    keyed = columns_of(docs, {"doc_id": id_col, "text": text_col})
    keyed = keyed.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("d"), F.xxhash64("text").alias("th"), "text")
    runs = minimisers(keyed.select("d", "th", "text"), window, size)
    shared = runs.groupBy("m").agg(F.min("d").alias("a"), F.max("d").alias("b"), F.sum("n").alias("c")).where("a < b")
    kept = runs.join(shared.select("m", (F.col("c") > hot).alias("hot")), "m")
    # A set: rows that repeat an id and a text bring equal runs.
    kept = kept.groupBy("d", "th").agg(F.collect_set(F.struct("first", "n", "m", "hot")).alias("runs"))
    # Only texts with shared minimisers go on; each packs a run once.
    held = cut(compressed(keyed.select("d", "th", "text")).join(kept, ["d", "th"]))
    cold = held.withColumn("runs", F.filter("runs", lambda r: ~r["hot"])).where(F.size("runs") > 0)
    warm = held.withColumn("runs", F.filter("runs", lambda r: r["hot"])).where(F.size("runs") > 0)
    least = _sorted_buckets(_pack(cold, window), window).unionByName(_dealt_windows(cut(_pack(warm, window)), window))
    spans = _spans(_occurrences(held, window).join(least, "pid"))
    spans = spans.groupBy("d", "th").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))
    return keyed, held.select("d", "th", "z").join(spans, ["d", "th"])


def _left(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, list[bytes]]]]]:
    """For each batch of ``removed``: how many words go, and those that stay."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    for b in batches:
        out = []
        for z, spans in zip(b.column("z"), b.column("spans").to_pylist()):
            words = press.decompress(z.as_py()).split()
            left = [w for w, k in zip(words, _mask(len(words), spans, window).tolist()) if k]
            out.append((len(words) - len(left), left))
        yield b, out


def _mask(n: int, spans: list[dict], window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["lo"]] += 1
        edge[s["hi"] + window - 1] -= 1
    return np.cumsum(edge[:-1]) == 0


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, size: int = MINIMISER, hot: int = HOT) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    keyed, removed = dedup(docs, id_col, text_col, window, size, hot)
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(len(w), _whole(w)) for w in map(_words, b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("d"), b.column("th"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "d", "th", "n_words", "sha"])

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in _left(batches, window):
            yield pa.RecordBatch.from_arrays([b.column("d"), b.column("th"), pa.array([n for n, _ in rows], pa.int64()), pa.array([_whole(w) for _, w in rows], pa.string())], ["d", "th", "n_removed", "kept"])

    every = keyed.mapInArrow(whole, f"doc_id {kind}, d long, th long, n_words long, sha string")
    less = removed.mapInArrow(thinned, "d long, th long, n_removed long, kept string").dropDuplicates(["d", "th"])
    out = every.join(less, ["d", "th"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, size: int = MINIMISER, hot: int = HOT) -> DataFrame:
    """``doc_id, text`` with the repeated windows' words removed (a text
    that loses none stays as it is)."""
    keyed, removed = dedup(docs, id_col, text_col, window, size, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in _left(batches, window):
            yield pa.RecordBatch.from_arrays([b.column("d"), b.column("th"), pa.array([b" ".join(w).decode() for _, w in rows], pa.string())], ["d", "th", "less"])

    less = removed.mapInArrow(run, "d long, th long, less string").dropDuplicates(["d", "th"])
    return keyed.join(less, ["d", "th"], "left").select("doc_id", F.coalesce("less", "text").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(prepare(spark), sf_dir, "documents"))


OP7_SQL = rf"""
WITH texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW} + 2)) AS s FROM texts WHERE len(words) >= {WINDOW}),
keyed AS (SELECT doc_id, s, md5(array_to_string(list_slice(words, s, s + {WINDOW} - 1), ' ')) AS key FROM starts),
least AS (SELECT key, min(doc_id) AS least FROM keyed GROUP BY key HAVING count(*) > 1),
windows AS (SELECT k.doc_id, k.s, l.least FROM keyed k JOIN least l ON k.key = l.key),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM windows WHERE least < doc_id),
lost AS (SELECT doc_id, list(i) AS at, count(*) AS n FROM gone GROUP BY doc_id),
each_word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS text FROM each_word e
  LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(coalesce(l.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN lost l ON l.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
