"""Counts and ranges read from Parquet footers alone.

COUNT, MIN and MAX without a filter need no rows: every row group's footer has
its row count and its columns' statistics.  Spark pushes such aggregates into
its V2 Parquet scan; these frames are built in a session of their own that
reads Parquet that way, so the caller's settings stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from .warehouse import Warehouse

#: Types whose footers bound them exactly (text may be cut, decimals vary).
_BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType, T.FloatType, T.DoubleType)


def footer_session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_stats(own: SparkSession, paths: Sequence[str], schema: T.StructType, ranges: Sequence[str]) -> DataFrame:
    """``cnt`` and, for each column of ``ranges``, ``min_<c>, max_<c>`` over
    Parquet folders; one row."""
    for c in ranges:
        if not isinstance(schema[c].dataType, _BOUNDED):
            raise ValueError(f"{c}: footers do not bound {schema[c].dataType.simpleString()} values")
    df = own.read.schema(schema).parquet(*paths)
    # Pushed down, the count of files without row groups comes back as NULL.
    return df.agg(F.greatest(F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("cnt"), *[f(c).alias(f"{n}_{c}") for c in ranges for n, f in (("min", F.min), ("max", F.max))])


def table_stats(wh: Warehouse, ranges: dict[str, str]) -> DataFrame:
    """W12 and more: ``table_name, cnt, first, last`` of the published tables;
    ``ranges`` names a whole-number column of each (for a partition column
    take another one: it stands in no file)."""
    own, out = footer_session(wh.spark), None
    for name, column in ranges.items():
        live = wh.snapshots.tables().get(name, {})
        paths = [p for held in wh.snapshots.paths(live).values() for p in held]
        kept = T.StructType([f for f in C.TABLE_SCHEMAS[name].fields if f.name != C.PARTITIONED_BY.get(name)])
        if paths:
            one = footer_stats(own, paths, kept, [column])
        else:
            one = own.createDataFrame([(0, None, None)], f"cnt bigint, min_{column} int, max_{column} int")
        one = one.select(F.lit(name).alias("table_name"), "cnt", F.col(f"min_{column}").cast("bigint").alias("first"), F.col(f"max_{column}").cast("bigint").alias("last"))
        out = one if out is None else out.unionByName(one)
    return out
