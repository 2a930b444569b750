"""SimHash near-duplicates: tiled exact comparison with exclusive-or and bit
counts, skipping tile pairs whose population counts differ too much.

Fingerprint: majority bits of the XXH64 (seed 42) of all word shingles.
Only distinct fingerprints are compared.  A tile holds the fingerprints
with equal population counts in each 16-bit quarter.  Two fingerprints at
distance d have quarter counts that differ by at most d in total, so a tile
meets only the tiles within that distance (41 of up to 83,521 for radius
2): an exact test, stronger than the one on the whole count.  A tile with
more than ``block`` rows is dealt over several cells, each holding one
block of it against the whole stream of its partners, so no cell keeps
more than a block in memory.

A cell reports its links as stars of local components: at most one edge a
row, never all pairs of a dense group, and no link is lost for
connectivity.  Components then run over distinct fingerprints.

Defined cases: null or blank text has fingerprint 0, linked like any
other; fewer words than a shingle give one shingle of them all; repeated
rows and copies share a fingerprint and so a component; a null id never
names a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, cut, partitions, prepare, table
from ledgerloom.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
BLOCK = 8192
_CHUNK = 1 << 15
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text, unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks cut
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*[words[i:] for i in range(shingle)])]
    counts = np.zeros((8, 256), dtype=np.int64)
    for at in range(0, len(grams), _CHUNK):
        h = np.array([xxh64_intdigest(g, SEED) for g in grams[at:at + _CHUNK]], dtype="<u8")
        by_byte = h.view(np.uint8).reshape(-1, 8) + (np.arange(8) * 256)
        counts += np.bincount(by_byte.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BITS).ravel()  # bit 8 * byte + i
    bits = (2 * ones > len(grams)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` with ``fp`` as a signed 64-bit integer, and the columns
    named in ``also``."""
    d = columns_of(docs, {"doc_id": id_col, **{c: c for c in also}, "text": text_col})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))], ["doc_id", *also, "fp"])

    return d.mapInArrow(run, f"{kinds}, fp long")


def _signature(counts: list):
    code = F.lit(0)
    for c in counts:
        code = code * F.lit(17) + c
    return code


def _offsets(radius: int) -> list[tuple[int, int, int, int]]:
    """Differences of quarter counts up to ``radius`` in total, half of them
    (the others are met from the other tile), the zero difference first."""
    span = range(-radius, radius + 1)
    every = [(a, b, c, d) for a in span for b in span for c in span for d in span if abs(a) + abs(b) + abs(c) + abs(d) <= radius]
    return sorted(o for o in every if o >= (0, 0, 0, 0))


def cells(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Distinct ``fp`` rows dealt to comparison cells: ``tile, part, role,
    fp``; role 0 is the block a cell holds, role 1 its partners."""
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    f = fps.select("fp", *[q.alias(f"q{i}") for i, q in enumerate(quarters)])
    q = [F.col(f"q{i}") for i in range(4)]
    f = f.withColumn("tile", _signature(q))
    # One row per tile: at most 17**4 = 83,521 rows whatever the input.
    tiles = f.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    tiles = F.broadcast(cut(tiles.select("tile", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("parts"))))
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(o)]) for o in _offsets(radius)])
    f = f.join(tiles.withColumnRenamed("parts", "own"), "tile")
    f = f.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("own")).cast("int"))
    f = f.withColumnRenamed("tile", "home").withColumn("o", F.explode(moves))
    to = [F.col(f"q{i}") + F.col(f"o.d{i}") for i in range(4)]
    inside = None
    for t in to:
        c = (t >= 0) & (t <= 16)
        inside = c if inside is None else inside & c
    f = f.where(inside).select("fp", "home", "mine", _signature(to).alias("tile")).join(tiles, "tile")
    # At home: held by its own block, a partner to the blocks before it.
    last = F.when(F.col("tile") == F.col("home"), F.col("mine")).otherwise(F.col("parts") - 1)
    f = f.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    role = F.when((F.col("tile") == F.col("home")) & (F.col("part") == F.col("mine")), 0).otherwise(1)
    return f.select("tile", "part", role.alias("role"), "fp")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Least-label merging of the links a-b, in place, until nothing moves."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label[:] = label[label]
        if np.array_equal(before, label):
            return


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and role; yields star edges ``u, v``."""

    def out(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def against(held, label, fresh):
        """Links of fresh rows to the held ones; merges the held rows that
        meet through one, and returns the fresh rows' own edges."""
        us, vs = [], []
        step = max(1, (1 << 20) // max(1, len(held)))
        for at in range(0, len(fresh), step):
            f = fresh[at:at + step]
            i, j = np.nonzero(np.bitwise_count(held[:, None] ^ f[None, :]) <= radius)
            if not len(i):
                continue
            first = np.full(len(f), len(held), dtype=np.int64)
            np.minimum.at(first, j, i)
            _merge(label, first[j], i)
            linked = np.flatnonzero(first < len(held))
            us.append(f[linked])
            vs.append(held[first[linked]])
        return us, vs

    def within(held, label):
        step = max(1, (1 << 20) // max(1, len(held)))
        for at in range(0, len(held), step):
            i, j = np.nonzero(np.bitwise_count(held[:, None] ^ held[None, at:at + step]) <= radius)
            _merge(label, i, j + at)

    cell, held, label, open_ = None, None, None, []

    def close():
        moved = np.flatnonzero(label != np.arange(len(label)))
        return out(held[moved], held[label[moved]])

    for b in batches:
        if not b.num_rows:
            continue
        tile, part, role = (b.column(n).to_numpy(zero_copy_only=False) for n in ("tile", "part", "role"))
        fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        key = (tile.astype(np.int64) << 33) | (part.astype(np.int64) << 1)
        edge = np.flatnonzero(np.diff(key | role)) + 1
        for lo, hi in zip(np.r_[0, edge], np.r_[edge, len(key)]):
            if key[lo] != cell:
                if held is not None or open_:
                    if held is None:
                        held = np.concatenate(open_)
                        label = np.arange(len(held))
                        within(held, label)
                    yield close()
                cell, held, label, open_ = key[lo], None, None, []
            if role[lo] == 0:
                open_.append(fp[lo:hi].copy())
                continue
            if held is None:
                held = np.concatenate(open_) if open_ else np.zeros(0, np.uint64)
                label, open_ = np.arange(len(held)), []
                within(held, label)
            us, vs = against(held, label, fp[lo:hi])
            if us:
                yield out(np.concatenate(us), np.concatenate(vs))
    if cell is not None:
        if held is None:
            held = np.concatenate(open_)
            label = np.arange(len(held))
            within(held, label)
        yield close()


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Star edges ``u, v`` between distinct fingerprints whose components
    are those of all links within ``radius``."""
    dealt = cells(fps.select("fp").distinct(), radius, block)
    dealt = dealt.repartition(partitions(fps.sparkSession), "tile", "part").sortWithinPartitions("tile", "part", "role")
    return dealt.mapInArrow(lambda it: _compare(it, radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the least id reachable over
    links of at most ``radius`` differing bits, itself included."""
    spark = prepare(docs.sparkSession)
    own = cut(with_fingerprints(docs, id_col, text_col, shingle))
    each = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = each.join(roots(own, radius, block), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # The least id of a component, combined before it meets its members.
    firsts = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = cut(named.select("fp", "root").join(firsts, "root").select(F.col("fp").alias("_fp"), "component_id"))
    out = own.join(members, own["fp"] == members["_fp"])
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", text.alias("fingerprint"), "component_id")


def roots(own: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``node, root``: linked fingerprints and the one that stands for
    their component (it has no row of its own)."""
    return cut(components(links(own, radius, block)))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of fingerprints: that of the
    least id (rows without an id come last; of rows that share it, the one of
    the least digest).  Unrelated texts under one id are in components of
    their own and stay each."""
    prepare(docs.sparkSession)
    # A row's content as 128 bits; a null counts as such.
    content = [x for c in docs.columns for x in (docs[c].isNull(), docs[c])]
    keyed = docs.withColumns({f"__row{k}": F.xxhash64(F.lit(k), *content) for k in (0, 1)})
    row = ["__row0", "__row1"]
    own = cut(with_fingerprints(keyed, id_col, text_col, also=tuple(row)))
    named = own.join(roots(own), F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *row)).alias("first"))
    keep = first.select(*[F.col("first")[r].alias(r) for r in row]).distinct()
    return keyed.join(keep, row, "left_semi").dropDuplicates(row).drop(*row)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(prepare(spark), sf_dir, "documents"))
