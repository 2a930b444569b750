"""Surrogate keys: get-or-create dimension members.

Natural keys are compared with ``<=>`` (NULL matches NULL), as the lookup
does.  New members are numbered after the current maximum key in the total
order of their natural key (ascending, NULLs first), so a rerun assigns the
same keys.  They are range-partitioned on that order and written to the
shared folder once; each range counts its rows, and the ranges' offsets are
added to a row number within the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scale import materialized_segments, null_safe_on

def number_rows(df: DataFrame, order_cols: Sequence[str], key_col: str, start_after=None) -> DataFrame:
    """Dense 1..n numbering of distinct rows in ``order_cols`` order, plus
    ``start_after`` (a Column, e.g. a scalar subquery)."""
    order_cols = list(order_cols)
    base = F.lit(0) if start_after is None else F.coalesce(start_after, F.lit(0))
    seg = materialized_segments(df, order_cols)
    counts = seg.groupBy("_seg").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the input, whatever its size.
    offsets = counts.select(
        "_seg",
        F.coalesce(F.sum("_n").over(Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
    )
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    rn = F.row_number().over(Window.partitionBy("_seg").orderBy(*order))
    out = seg.join(offsets, "_seg").withColumn(key_col, (base + F.col("_off") + rn).cast("int"))
    return out.drop("_seg", "_off")


def first_keys(dim: DataFrame, natural: Sequence[str], key_col: str) -> DataFrame:
    """The lowest key of every natural key (a dimension may hold
    duplicates when NULL levels escaped a UNIQUE index)."""
    return dim.groupBy(*natural).agg(F.min(key_col).alias(key_col))


def get_or_create(dim: DataFrame, incoming: DataFrame, natural: Sequence[str], key_col: str) -> tuple[DataFrame, DataFrame]:
    """Returns ``(dim_after, new_members)``.

    ``dim_after`` is the existing dimension plus one new row per natural key
    not found (null-safe); ``new_members`` holds just the new rows.
    """
    natural = list(natural)
    members = incoming.select(*natural).distinct()
    found = first_keys(dim, natural, key_col)
    new = members.join(found, null_safe_on(members, found, natural), "left_anti")
    max_key = dim.agg(F.max(key_col)).scalar()
    new = number_rows(new, natural, key_col, start_after=max_key).select(key_col, *natural)
    return dim.select(key_col, *natural).unionByName(new), new


def stamp_keys(rows: DataFrame, dim: DataFrame, natural: Sequence[str], key_col: str) -> DataFrame:
    """Attach ``key_col`` to rows by null-safe natural-key lookup (first key
    wins); the natural-key columns are replaced by the key.  AQE broadcasts
    the dimension where its measured size allows."""
    natural = list(natural)
    found = first_keys(dim, natural, key_col)
    j = rows.join(found, null_safe_on(rows, found, natural), "left")
    keep = [rows[c] for c in rows.columns if c not in natural]
    return j.select(*keep, found[key_col])


def keys_in_load_order(members: DataFrame, load_col: str, natural: Sequence[str],
                       key_col: str) -> DataFrame:
    """J7 over successive loads into an empty dimension, in one pass.

    ``members`` carries the load number in which each natural key appears
    (it may appear in several).  A key's first load decides its block, and
    within a block keys follow the natural order, which is exactly what
    running :func:`get_or_create` load after load assigns.
    """
    natural = list(natural)
    first = members.groupBy(*natural).agg(F.min(load_col).alias("_load"))
    return number_rows(first, ["_load"] + natural, key_col).select(key_col, *natural)
