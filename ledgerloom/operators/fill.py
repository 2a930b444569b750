"""W-1 / Q5: forward fill inside groups, in an explicit order.

Leading NULLs stay NULL and a fill never crosses its group.  Two plans:

* ``split_hot_groups=False`` — one window per group.  Right for small
  groups (the quarterly base, where a group is one year).
* ``split_hot_groups=True`` (default) — a group may hold a large share of
  all rows, so it must not land in one task.  Rows are range-partitioned on
  (group, order) once and written to the shared folder with their segment's
  number; each (group, segment) is filled with a window, and the value a
  group carries into a segment comes from one partial aggregate per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scale import materialized_segments


def _window_fill(df: DataFrame, cols: Sequence[str], group: Sequence[str], order: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def forward_fill(df: DataFrame, cols: Sequence[str], partition_by: Sequence[str], order_by: Sequence[str],
                 split_hot_groups: bool = True, segments: int | None = None) -> DataFrame:
    """Fill NULLs in ``cols`` from the latest earlier non-NULL value of the
    same group.  ``order_by`` must order rows uniquely within a group."""
    cols, group, order = list(cols), list(partition_by), list(order_by)
    if not split_hot_groups:
        return _window_fill(df, cols, group, order)

    seg = materialized_segments(df, group + order, segments)
    local = _window_fill(seg, cols, group + ["_seg"], order)

    # Per segment: its first and last group, and for each column the last
    # row that holds a value.  That row counts as the last group's end only
    # if it belongs to the last group.
    g_key = F.struct(*[F.col(g) for g in group])
    order_key = F.struct(*[F.col(c) for c in order])
    ends = seg.groupBy("_seg").agg(
        F.min(g_key).alias("_head"), F.max(g_key).alias("_tail"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(g_key.alias("g"), order_key.alias("o"), F.col(c).alias("v")))).alias(f"_at_{c}") for c in cols])
    ends = ends.select("_seg", "_head", "_tail", *[
        F.when(F.col(f"_at_{c}.g").eqNullSafe(F.col("_tail")), F.col(f"_at_{c}.v")).alias(f"_end_{c}") for c in cols])
    ends = ends.select(
        "_seg",
        *[F.col("_head").getField(g).alias(f"_head_{g}") for g in group],
        *[F.col("_tail").getField(g).alias(f"_tail_{g}") for g in group],
        *[F.col(f"_end_{c}") for c in cols],
    )
    # Carry into segment s: the latest non-NULL end value among earlier
    # segments whose last group is s's first group.  Each summary row gives
    # a head row (kind 0) and a tail row (kind 1), emitted by one explode so
    # the summary is computed once; both share one window per group, ordered
    # by segment, so a head only sees tails of strictly earlier segments.
    def side(kind: int, prefix: str, values: list) -> F.Column:
        return F.struct(F.lit(kind).alias("_kind"),
                        *[F.col(f"{prefix}{g}").alias(f"_g_{g}") for g in group], *values)

    head_values = [F.lit(None).cast(local.schema[c].dataType).alias(f"_end_{c}") for c in cols]
    tail_values = [F.col(f"_end_{c}").alias(f"_end_{c}") for c in cols]
    marks = ends.select("_seg", F.explode(F.array(side(0, "_head_", head_values),
                                                  side(1, "_tail_", tail_values))).alias("_m")
                        ).select("_seg", "_m.*")
    w = (Window.partitionBy(*[f"_g_{g}" for g in group]).orderBy("_seg", "_kind")
         .rowsBetween(Window.unboundedPreceding, -1))
    carry = (
        marks.select("_seg", "_kind", *[f"_g_{g}" for g in group],
                     *[F.last(f"_end_{c}", ignorenulls=True).over(w).alias(f"_carry_{c}") for c in cols])
        .where(F.col("_kind") == 0)
        .drop("_kind")
    )
    # One row per segment, and a segment is a partition of the fill's input:
    # bounded by the number of partitions.
    out = local.join(
        F.broadcast(carry),
        on=[local["_seg"] == carry["_seg"]] + [local[g].eqNullSafe(carry[f"_g_{g}"]) for g in group],
        how="left",
    )
    return out.select(
        *[F.coalesce(local[c], carry[f"_carry_{c}"]).alias(c) if c in cols else local[c] for c in df.columns]
    )
