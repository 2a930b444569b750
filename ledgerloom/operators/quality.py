"""Data-quality operators: reject capture, uniqueness, range gates (Q1–Q6).

Every gate is a pure function returning ``(clean, rejects)``; nothing is
collected in a global list.  Rejects share one ragged shape and are combined
with :func:`union_rejects`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import MEASURES, NON_NEGATIVE, REJECT_DEFAULT_COLUMNS
from ..functions.money import out_of_contract
from ..session import ensure_checkpoint_dir
from .scale import spread_copies


def _order_exprs(order_by: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def dq_capture(df: DataFrame, condition: Column, reason: str, keep_cols: Sequence[str] | None = None) -> DataFrame:
    """Q1: snapshot of the rows matching ``condition`` with a ``dq_reason``."""
    if keep_cols is None:
        keep_cols = [c for c in REJECT_DEFAULT_COLUMNS if c in df.columns]
    return df.where(F.coalesce(condition, F.lit(False))).select(*keep_cols, F.lit(reason).alias("dq_reason"))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence, count_as: str | None = None) -> DataFrame:
    """W-2 / W-3: one row per key, the first in ``order_by`` (ascending,
    NULLs first); remaining columns break ties, so the pick is deterministic.

    Implemented as ``min(struct(order…, rest…))`` per key: the aggregate runs
    partially on the map side, so a key holding a large share of all rows
    collapses to one row per task before the shuffle.  ``count_as`` adds the
    number of rows of the key.
    """
    keys = list(keys)
    order = _order_exprs(order_by)
    rest = [c for c in df.columns if c not in keys]
    # A plain order column is its own field: it is not carried twice.
    named = [c for c in order_by if isinstance(c, str) and c in rest]
    fields = [F.col(o) if o in named else e.alias(f"_o{i}") for i, (o, e) in enumerate(zip(order_by, order))]
    fields += [F.col(c) for c in rest if c not in named]
    counts = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    first = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"), *counts)
    out = [*df.columns, *([count_as] if count_as else [])]
    return first.select("*", *[F.col("_first").getField(c).alias(c) for c in rest]).select(*out)


def last_per_key(df: DataFrame, keys: Sequence[str], load_order: Sequence[str], reason: str) -> tuple[DataFrame, DataFrame]:
    """The last row of each key in ``load_order`` (remaining columns break
    ties), as row-by-row upserts would leave it, and one reject per row
    that it replaces.  Partial aggregation, so a hot key is combined before
    the shuffle."""
    keys, load_order = list(keys), list(load_order)
    rest = [c for c in df.columns if c not in keys and c not in load_order]
    last = df.groupBy(*keys).agg(F.max(F.struct(*load_order, *rest)).alias("_last"))
    kept = last.select(*keys, *[F.col("_last").getField(c).alias(c) for c in [*load_order, *rest]]).select(*df.columns)
    return kept, duplicate_key_rejects(df, keys, reason)


def precision_gate(df: DataFrame, cols: Sequence[str] = MEASURES, keep_cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Values that do not fit their load type are rejected as
    ``<col>_out_of_contract``, then set to NULL."""
    rejects, out = [], df
    for col in [c for c in cols if c in df.columns]:
        bad = F.coalesce(out_of_contract(col, col), F.lit(False))
        keep = keep_cols or [k for k in ("year", "quarter_num", "quarter_key") if k in df.columns]
        rejects.append(dq_capture(df, bad, f"{col}_out_of_contract", [*[k for k in keep if k != col], col]))
        out = out.withColumn(col, F.when(~bad, F.col(col)))
    return out, union_rejects(*rejects)


def duplicate_key_rejects(df: DataFrame, keys: Sequence[str], reason: str) -> DataFrame:
    """Q2 rejects: every duplicate after the first, as its key columns."""
    keys = list(keys)
    extra = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_extra")).where(F.col("_extra") > 0)
    return spread_copies(extra, "_extra").withColumn("dq_reason", F.lit(reason))


def ensure_unique(df: DataFrame, keys: Sequence[str], order_by: Sequence, name: str) -> tuple[DataFrame, DataFrame]:
    """Q2: keep the first row per key; the others are rejected with reason
    ``<name>_duplicate_keys`` (key columns only)."""
    clean = keep_first(df, keys, order_by)
    rejects = duplicate_key_rejects(df, keys, f"{name}_duplicate_keys")
    return clean, rejects


def copies_as_rejects(counted: DataFrame, count: Column | str, cols: Sequence[str], reason: str) -> DataFrame:
    """Q2 rejects from counts: ``count`` copies of each row's ``cols``."""
    n = F.col(count) if isinstance(count, str) else count
    return spread_copies(counted.select(*cols, n.alias("_extra")).where("_extra > 0"), "_extra").withColumn("dq_reason", F.lit(reason))


def ensure_unique_once(df: DataFrame, keys: Sequence[str], order_by: Sequence, name: str) -> tuple[DataFrame, DataFrame]:
    """Q2 as :func:`ensure_unique`, with ``df`` read once: first rows and
    counts come from one materialised aggregate (a row a key)."""
    ensure_checkpoint_dir(df.sparkSession)
    counted = keep_first(df, keys, order_by, count_as="_rows").checkpoint(eager=True)
    return counted.drop("_rows"), copies_as_rejects(counted, F.col("_rows") - 1, list(keys), f"{name}_duplicate_keys")


def range_gate(df: DataFrame, col: str, lo: float = 0.0, hi: float = 1.0,
               reason: str | None = None, keep_cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Q3: values outside ``[lo, hi]`` are rejected, then set to NULL.
    NULL passes; NaN counts as out of range."""
    c = F.col(col)
    bad = c.isNotNull() & (F.isnan(c) | ~c.between(lo, hi))
    if keep_cols is None:
        keep_cols = [k for k in ("year", "quarter_num") if k in df.columns] + [col]
    rejects = dq_capture(df, bad, reason or f"{col}_out_of_range", keep_cols)
    return df.withColumn(col, F.when(~F.coalesce(bad, F.lit(False)), c)), rejects


def nonneg_gate(df: DataFrame, cols: Sequence[str] = NON_NEGATIVE,
                key_cols: Sequence[str] = ("year", "quarter_num")) -> tuple[DataFrame, DataFrame]:
    """Q4: negative values are rejected as ``negative_<col>``, then NULLed.
    A NULL comparison is false."""
    rejects = []
    out = df
    for col in cols:
        if col not in df.columns:
            continue
        bad = F.coalesce(F.col(col) < 0, F.lit(False))
        keep = [k for k in key_cols if k in df.columns] + [col]
        rejects.append(dq_capture(out, bad, f"negative_{col}", keep))
        out = out.withColumn(col, F.when(~bad, F.col(col)))
    return out, union_rejects(*rejects)


def union_rejects(*frames: DataFrame) -> DataFrame | None:
    """Ragged union of reject frames (missing columns become NULL)."""
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    cols = [c for c in out.columns if c != "dq_reason"] + ["dq_reason"]
    return out.select(*cols)


def reject_summary(rejects: DataFrame) -> DataFrame:
    """K2: reject rows counted by reason."""
    return rejects.groupBy("dq_reason").agg(F.count(F.lit(1)).alias("reject_rows"))
