"""Helpers that keep plans safe on skewed, very large inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread_copies(df: DataFrame, count_col: str, chunk: int = 1 << 16) -> DataFrame:
    """Emit ``count_col`` copies of every row, spread over many tasks.

    A row asking for millions of copies (a hot duplicate key) is first cut
    into chunk descriptors, which a fixed-count repartition spreads over the
    cluster; each task then generates at most ``chunk`` rows per descriptor.
    """
    spark = df.sparkSession
    n = F.col(count_col).cast("long")
    chunks = df.where(n > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(chunk)).cast("long")))
    )
    # An explicit partition count is never coalesced by AQE.
    chunks = chunks.repartition(shuffle_partitions(spark), *[F.col(c) for c in df.columns], "_chunk")
    lo = F.col("_chunk") * F.lit(chunk)
    hi = F.least(lo + F.lit(chunk), n) - F.lit(1)
    return chunks.withColumn("_copy", F.explode(F.sequence(lo, hi))).drop("_chunk", "_copy", count_col)


def null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    """Join condition with ``<=>`` on every column (NULL matches NULL)."""
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def materialized_segments(df: DataFrame, cols: list[str], n_seg: int | None = None) -> DataFrame:
    """The rows cut into contiguous ranges of ``cols`` (ascending, NULLs
    first) with the range's number as ``_seg``.

    Spark's own range partitioning chooses the bounds, so a key range that
    holds many rows spreads over many segments.  The result is written to
    the shared checkpoint folder once: every branch and every retried task
    reads the same numbers.  Rows that agree on all of ``cols`` share a
    segment.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [F.col(c).asc_nulls_first() for c in cols]
    cut = df.repartitionByRange(n_seg or shuffle_partitions(spark), *order)
    return cut.withColumn("_seg", F.spark_partition_id()).checkpoint(eager=True)
