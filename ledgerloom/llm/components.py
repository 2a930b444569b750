"""Connected components of an edge table by alternating stars.

Each round turns the edges into stars around smaller nodes (larger
neighbours to the least neighbour, then smaller neighbours likewise); the
rounds needed grow with the logarithm of the longest chain.  Edges never
leave the cluster; each round's edges are checkpointed, so a lost executor
costs one round at most.  A node with a third of all edges is combined on
the map side for its minimum, and its join is AQE's to split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` has u > v in every row."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    near = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame):
    """Count, sums of two 20-bit parts (longs for 2^43 edges) and parity."""
    h = F.xxhash64("u", "v")
    parts = [F.sum(F.shiftright(h, at).bitwiseAND(F.lit((1 << 20) - 1))) for at in (0, 20)]
    return tuple(e.agg(F.count(F.lit(1)), *parts, F.bit_xor(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` (any order) to ``node, root``: every node that has an edge to
    another one, but for the roots, with the least node it can reach.  Loops
    and repeated edges are ignored; no edges give an empty table."""
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(e)
    while mark[0]:
        e = cut(_small_star(_large_star(e)))
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
