"""Tables whose files were written under older contracts.

Every folder of files is read with the schema that its own files have, and
brought to the contract: a missing column becomes a typed NULL, a narrower
type is widened, and a value of a wider type that the contract cannot hold is
set to NULL and rejected.  Columns beyond the contract are kept, nullable.

A unique key that older loads did not keep is repaired: the row with the
lowest surrogate key stays, the others become rejects that name the key that
stands for them, so facts can be moved over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import union_rejects

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``."""
    if old == new:
        return True
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return _WHOLE.index(type(old)) < _WHOLE.index(type(new))
    if isinstance(new, T.DecimalType):
        if isinstance(old, T.DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return isinstance(old, _WHOLE) and new.precision - new.scale >= (3, 5, 10, 19)[_WHOLE.index(type(old))]
    if isinstance(new, T.DoubleType):
        return isinstance(old, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    return isinstance(new, T.StringType) and isinstance(old, _WHOLE)


def _fitted(c: str, old: T.DataType, new: T.DataType) -> tuple[Column, Column]:
    """A column in the contract's type, and whether its value got lost."""
    value = F.col(f"`{c}`")
    if widens(old, new):
        return value.cast(new), F.lit(False)
    made = value.try_cast(new)
    # A cast that rounds or cuts does not give the value back.
    same = made.cast(old).eqNullSafe(value) if not isinstance(old, T.StringType) else made.isNotNull() | value.isNull()
    return F.when(same, made), value.isNotNull() & ~same


def to_contract(df: DataFrame, contract: T.StructType, key: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """W8 on one schema: ``(rows, rejects)``; a reject has the row's key and
    ``<col>_out_of_contract``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols, lost = [], []
    for f in contract.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, bad = _fitted(f.name, have[f.name], f.dataType)
        cols.append(value.alias(f.name))
        if not widens(have[f.name], f.dataType):
            keys = [_fitted(k, have[k], contract[k].dataType)[0].alias(k) for k in key if k in have]
            lost.append(df.where(bad).select(*keys, F.lit(f"{f.name}_out_of_contract").alias("dq_reason")))
    extra = [F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`")).alias(c) for c in have if c not in contract.fieldNames()]
    return df.select(*cols, *extra), union_rejects(*lost)


def read_generations(spark: SparkSession, folders: Sequence[str], contract: T.StructType, key: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """S10 + W8: folders of Parquet files, each of one schema (one footer is
    read a folder), as one frame of the contract, and the rejects."""
    rows, rejects = None, []
    for folder in folders:
        one, lost = to_contract(spark.read.parquet(folder), contract, key)
        rejects.append(lost)
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    return (spark.createDataFrame([], contract) if rows is None else rows), union_rejects(*rejects)


def repair_unique(dim: DataFrame, natural: Sequence[str], key: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """One row a natural key (NULL equals NULL), the one of the lowest
    ``key``; the others as rejects with ``kept_<key>``.  The lowest keys are a
    partial aggregate; the rows are not sorted."""
    natural = list(natural)
    lowest = dim.groupBy(*[F.col(n).alias(f"_n_{n}") for n in natural]).agg(F.min(key).alias(f"kept_{key}"))
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_n_{n}")) for n in natural])
    both = dim.join(lowest, same).select(*dim.columns, f"kept_{key}")
    rest = F.col(key) != F.col(f"kept_{key}")
    return both.where(~rest).drop(f"kept_{key}"), both.where(rest).select(key, f"kept_{key}", F.lit(reason).alias("dq_reason"))


def move_keys(rows: DataFrame, losers: DataFrame, key: str) -> DataFrame:
    """Rows that refer to a repaired dimension, with each key that went
    replaced by the one that was kept."""
    moved = losers.select(F.col(key).alias("_old"), F.col(f"kept_{key}").alias("_new"))
    out = rows.join(moved, rows[key] == moved["_old"], "left")
    return out.withColumn(key, F.coalesce("_new", key)).select(*rows.columns)
