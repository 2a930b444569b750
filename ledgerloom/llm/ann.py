"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``HASHES`` Gaussian projections cut in slots of
``SLOT`` times the typical neighbour distance r, which is fitted on a
bounded sample (``FIT_ROWS`` vectors).  A neighbour at distance r lies in a
slot of each projection with a probability that the normal law gives; a
query visits the buckets around its own in the order of the product of
these, until they add up to ``SUCCESS``.  Candidates of all tables are
merged and ranked by their exact distance, computed in double precision.

r is one number for all densities, so each query is judged by the distance d
of its own k-th result: the normal law gives the chance that a neighbour at d
lies in the buckets visited.  Below ``SURE`` the query visits more of them,
in the order of their chance at d, until it is ``SURE``.  Where buckets as
narrow as r would have to be visited in larger number than one table has
cells, it is searched in every cell instead.

Equal vectors are one candidate class that keeps its ``k + 1`` least ids
(no result can need more), so a vector repeated a million times is compared
once.  Buckets are dealt over cells of at most ``BLOCK`` vectors each; a
cell answers with the nearest classes of each query, never with all pairs.
A query with fewer than k results found is searched in every cell as well.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part; neither do vectors of another length than the
most frequent one (of these, the least); repeated rows of one id count
once; with k candidates or fewer a query gets all of them; no vectors
give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, cut, drawn, partitions, prepare, small, table

TABLES, HASHES, SLOT, SUCCESS = 3, 6, 2.0, 0.6
SURE = 0.95  # of finding a neighbour at the distance of the k-th result
REACH = 2  # slots looked at on each side: beyond 2 slots = 4 r lies nothing
K = 10
FIT_ROWS = 2_000
BLOCK = 4096
SEED = 20_240


def vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, vec, digest`` of the vectors that take part; ``vec`` holds
    their components as little-endian doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, vecs, digests = [], [], []
            for i, v in zip(b.column("id").to_pylist(), b.column("vec")):
                if i is None or not v.is_valid or v.values.null_count:
                    continue
                x = np.asarray(v.values.to_numpy(zero_copy_only=False), "<f8")
                if len(x) and np.isfinite(x).all() and x.any():
                    raw = (x + 0.0).tobytes()  # -0.0 becomes 0.0
                    ids.append(i)
                    vecs.append(raw)
                    digests.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())], ["id", "vec", "digest"])

    d = columns_of(df, {"id": id_col, "vec": vec_col})
    v = d.select(F.col("id").cast("long").alias("id"), "vec").mapInArrow(run, "id long, vec binary, digest binary")
    return v


def classes_of(v: DataFrame, k: int) -> DataFrame:
    """``cls, vec, digest, ids``: distinct vectors with their k + 1 least
    ids; the rank limit applies before the shuffle."""
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("id"))
    few = v.dropDuplicates(["digest", "id"]).withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return few.groupBy("digest").agg(F.min("id").alias("cls"), F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))


class Hashing:
    """The tables' projections, and the probes of a query."""

    def __init__(self, dims: int, r: float):
        rng = np.random.default_rng(SEED)
        self.r, self.width = r, SLOT * r
        self.a = rng.normal(size=(TABLES, dims, HASHES))
        self.b = rng.uniform(0, self.width, size=(TABLES, 1, HASHES))
        self.mix = rng.integers(1, 1 << 62, size=HASHES, dtype=np.int64) | 1

    def places(self, x: np.ndarray) -> np.ndarray:
        """Positions in slots: tables x rows x hashes."""
        return (x @ self.a + self.b) / self.width

    def key(self, slots: np.ndarray) -> np.ndarray:
        """A 64-bit name of a bucket (a clash only joins two buckets)."""
        return (slots.astype(np.int64) * self.mix).sum(-1)

    def chances(self, place: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
        """The buckets around one query's place in one table, as slots a
        hash and the chance of each (flat, all combinations) to hold a
        neighbour at distance d."""
        slots = np.floor(place)[:, None] + np.arange(-REACH, REACH + 1)
        edges = (np.concatenate([slots, slots[:, -1:] + 1], axis=1) - place[:, None]) * (self.width / d)
        law = np.vectorize(lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2))))(edges)
        chance = np.diff(law, axis=1)
        product = chance[0]
        for row in chance[1:]:
            product = np.multiply.outer(product, row)
        return slots, product.ravel()

    def visited(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets that one query visits in one table, in the order of
        their estimated success, as flat positions; and the slots."""
        slots, flat = self.chances(place, self.r)
        order = np.argsort(-flat, kind="stable")
        return slots, order[:int(np.searchsorted(np.cumsum(flat[order]), SUCCESS * flat.sum())) + 1]

    def named(self, slots: np.ndarray, order: np.ndarray) -> np.ndarray:
        at = np.stack(np.unravel_index(order, (2 * REACH + 1,) * len(slots)), axis=1)
        return self.key(slots[np.arange(len(slots)), at])

    def probes(self, place: np.ndarray) -> np.ndarray:
        """Keys of the buckets that one query visits in one table."""
        return self.named(*self.visited(place))

    def more(self, places: np.ndarray, d: float, most: int) -> list[np.ndarray] | None:
        """Keys a table (none if the first visit was ``SURE`` at distance d)
        of the buckets that one query has to visit besides; None if they
        are not within reach or more than ``most``."""
        seen, chances = [self.visited(p) for p in places], [self.chances(p, d)[1] for p in places]
        nothing = [np.zeros(0, np.int64)] * len(places)
        if d <= 0 or math.prod(1 - c[o].sum() for (_, o), c in zip(seen, chances)) <= 1 - SURE:
            return nothing
        out, each = [], 1 - (1 - SURE) ** (1 / len(places))
        for (slots, first), flat in zip(seen, chances):
            rest = flat.copy()
            rest[first] = 0
            order = np.argsort(-rest, kind="stable")
            sums = flat[first].sum() + np.cumsum(rest[order])
            if sums[-1] < each:
                return None
            need = 0 if flat[first].sum() >= each else int(np.searchsorted(sums, each)) + 1
            out.append(self.named(slots, order[:need]))
        return out if sum(map(len, out)) <= most else None


def fit(classes: DataFrame, k: int) -> Hashing | None:
    """r is the median distance to the k-th neighbour within a sample of at
    most ``FIT_ROWS`` distinct vectors (drawn by hash)."""
    few = drawn(classes.select("vec", "digest"), "digest", classes.count(), 2 * FIT_ROWS)
    got = few.orderBy("digest").limit(FIT_ROWS).collect()
    if not got:
        return None
    x = np.array([np.frombuffer(r["vec"], "<f8") for r in got])
    d2 = np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * x @ x.T, 0)
    np.fill_diagonal(d2, np.inf)
    near = np.sort(d2, axis=1)[:, min(k, len(x) - 1) - 1] if len(x) > 1 else np.ones(1)
    r = float(np.median(np.sqrt(near)))
    return Hashing(x.shape[1], r if r > 0 else 1.0)


def _unpack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def hashed(classes: DataFrame, h: Hashing, probe: bool) -> DataFrame:
    """``t, key, cls, vec``: a row a table, or a row a probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            places = h.places(_unpack(b.column("vec")))
            for t in range(TABLES):
                keys = [h.probes(p) for p in places[t]] if probe else list(h.key(np.floor(places[t]))[:, None])
                of = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(of), t, np.int32)), pa.array(np.concatenate(keys)), b.column("cls").take(take), b.column("vec").take(take)], ["t", "key", "cls", "vec"])

    return classes.select("cls", "vec").mapInArrow(run, "t int, key long, cls long, vec binary")


def again(asked: DataFrame, h: Hashing, most: int) -> DataFrame:
    """``t, key, cls, vec``: a row a further probe of the queries ``cls, vec,
    d``; a query to be searched in every cell has one row, without a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            places = h.places(_unpack(b.column("vec")))
            for i, d in enumerate(b.column("d").to_pylist()):
                keys = None if d is None else [np.zeros(0, np.int64)] if d == 0 else h.more(places[:, i], d, most)
                ts = [None] if keys is None else np.repeat(np.arange(len(keys)), [len(x) for x in keys]).tolist()
                flat = [None] if keys is None else np.concatenate(keys).tolist()
                take = pa.array(np.full(len(ts), i))
                yield pa.RecordBatch.from_arrays([pa.array(ts, pa.int32()), pa.array(flat, pa.int64()), b.column("cls").take(take), b.column("vec").take(take)], ["t", "key", "cls", "vec"])

    return asked.select("cls", "vec", "d").mapInArrow(run, "t int, key long, cls long, vec binary")


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and role (0: the cell's vectors, 1: queries) to
    ``q, cls, dist``, the k + 1 nearest classes of the cell (ties kept)."""
    cell, held, ids, waiting = None, None, None, []
    for b in batches:
        if not b.num_rows:
            continue
        parts = [b.column(n).to_numpy(zero_copy_only=False) for n in ("t", "key", "part", "role")]
        edge = np.flatnonzero(np.any([np.diff(p) != 0 for p in parts], axis=0)) + 1
        for lo, hi in zip(np.r_[0, edge], np.r_[edge, b.num_rows]):
            at = tuple(int(p[lo]) for p in parts[:3])
            if at != cell:
                cell, held, ids, waiting = at, None, None, []
            rows = b.slice(lo, hi - lo)
            if parts[3][lo] == 0:
                waiting.append((_unpack(rows.column("vec")), rows.column("cls").to_numpy()))
                continue
            if held is None:
                if not waiting:
                    continue
                held, ids = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
                norms = (held * held).sum(1)
            x, own = _unpack(rows.column("vec")), rows.column("cls").to_numpy()
            q_out, c_out, d_out = [], [], []
            for s in range(0, len(x), 256):
                y = x[s:s + 256]
                rough = norms[None] + (y * y).sum(1)[:, None] - 2 * y @ held.T
                last = np.partition(rough, min(k, len(held) - 1), axis=1)[:, min(k, len(held) - 1)]
                slack = 1e-9 * (norms.max() + (y * y).sum(1) + 1e-300)
                i, j = np.nonzero(rough <= (last + slack)[:, None])
                q_out.append(own[s + i])
                c_out.append(ids[j])
                d_out.append(np.sqrt(((y[i] - held[j]) ** 2).sum(1)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in (q_out, c_out, d_out)], ["q", "cls", "dist"])


def _cells(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Candidate rows ``q, cls, dist``; ``base`` has ``part`` already."""
    names = ["t", "key", "part", "role", "cls", "vec"]
    rows = base.withColumn("role", F.lit(0)).select(*names).unionByName(asked.withColumn("role", F.lit(1)).select(*names))
    rows = rows.repartition(partitions(base.sparkSession), "t", "key", "part").sortWithinPartitions("t", "key", "part", "role")
    return rows.mapInArrow(lambda it: _search(it, k), "q long, cls long, dist double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """``q, cls, dist``: each query class's k + 1 nearest classes."""
    best = found.groupBy("q", "cls").agg(F.min("dist").alias("dist"))
    nth = F.row_number().over(Window.partitionBy("q").orderBy("dist", "cls"))
    return best.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")


def _ranked(best: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """``q, near``: each query class's k + 1 nearest ids with distances."""
    ids = best.join(classes.select("cls", "ids"), "cls").select("q", "dist", F.explode("ids").alias("id"))
    ids = ids.groupBy("q", "id").agg(F.min("dist").alias("dist"))
    nth = F.row_number().over(Window.partitionBy("q").orderBy("dist", "id"))
    ids = ids.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return ids.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("dist", "id"))).alias("near"))


def search(df: DataFrame, queries, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every row
    for which ``queries(id column)`` holds, against all rows but itself."""
    spark = prepare(df.sparkSession)
    v = vectors(df, id_col, vec_col)
    dims = v.groupBy(F.length("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    size = dims[0]["n"] if dims else 8
    v = cut(v.where(F.length("vec") == size))
    classes = cut(classes_of(v, k))
    h = fit(classes, k)
    if h is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = hashed(classes, h, False)
    buckets = cut(base.groupBy("t", "key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts")))
    few = small(buckets)
    base = base.join(few, ["t", "key"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    asks = v.where(queries(F.col("id"))).select("id", "digest").distinct()
    asked = asks.select("digest").distinct().join(classes.select("digest", "cls", "vec"), "digest").select("cls", "vec")
    asked = cut(asked)
    probes = hashed(asked, h, True).distinct().join(few, ["t", "key"])
    probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    best = cut(_best(_cells(base, probes, k), k))
    # Each query's own k-th distance (none: too few found) names what else it has to visit.
    kth = _ranked(best, classes, k).where(F.size("near") > k).select("q", F.col("near")[k]["dist"].alias("d"))
    every = buckets.where("t = 0")
    cells = every.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    further = cut(again(asked.join(kth, asked["cls"] == kth["q"], "left"), h, cells))
    probes = further.where("t IS NOT NULL").distinct().join(few, ["t", "key"])
    probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = best.unionByName(_cells(base, probes, k))
    exact = further.where("t IS NULL").select("cls", "vec")
    if not exact.isEmpty():
        every = exact.crossJoin(F.broadcast(every)) if every.count() <= 100_000 else exact.crossJoin(every)
        every = every.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        found = found.unionByName(_cells(base.where("t = 0"), every, k))
    near = cut(_ranked(_best(found, k), classes, k))
    named = near.join(classes.select("cls", F.col("digest").alias("_d")), F.col("q") == F.col("cls")).select("_d", "near")
    out = asks.join(named, F.col("digest") == F.col("_d")).select(F.col("id").alias("query_id"), F.filter("near", lambda x: x["id"] != F.col("id")).alias("near"))
    out = out.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("pos", "hit"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.dist").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(prepare(spark), sf_dir, "embeddings"), lambda i: i % 100 == 0)
