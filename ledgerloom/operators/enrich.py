"""Enrichment: base building, many-to-one rate joins and fan-out guard
(J1–J4, J8, A1, A2, P4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quarter import add_year_quarter, normalize_quarter, quarter_key

FANOUT_LIMIT = 1.01


def quarterly_mean(series: DataFrame, out_col: str, date_col: str = "date", value_col: str = "value",
                   quarter_col: str = "quarter", extra_keys: Sequence[str] = ()) -> DataFrame:
    """A1: daily (or any) series → mean per calendar quarter, NULLs ignored.

    Returns ``year, <quarter_col>, quarter_key, <out_col>``; the aggregate
    runs partially on every task before the (tiny) shuffle.
    """
    d = F.col(date_col)
    q = (series.groupBy(*extra_keys, F.year(d).alias("year"), F.quarter(d).alias(quarter_col))
         .agg(F.avg(value_col).alias(out_col)))
    return q.withColumn("quarter_key", quarter_key("year", quarter_col)).select(
        *extra_keys, "quarter_key", "year", quarter_col, out_col)


def prime_quarterly(series: DataFrame) -> DataFrame:
    """Prime-rate series (percent) → quarter_key, year, quarter, prime_rate."""
    return quarterly_mean(series, "prime_rate")


def default_quarterly(series: DataFrame) -> DataFrame:
    """Delinquency series (percent) → quarterly mean as a fraction."""
    q = quarterly_mean(series, "default_rate", quarter_col="quarter_num")
    return q.select("year", "quarter_num", (F.col("default_rate") / F.lit(100.0)).alias("default_rate"))


def join_balances(orig: DataFrame, bal: DataFrame, strict_raw_key: bool = False) -> DataFrame:
    """J1 + F7: originations LEFT balances by quarter, then quarter columns.

    By default both sides are joined on the normalised token (``2012 Q3``
    meets ``2012Q3``); ``strict_raw_key=True`` joins on the raw text.
    """
    if strict_raw_key:
        joined = orig.join(bal, "quarter", "left")
    else:
        o = orig.withColumn("_qk", normalize_quarter("quarter"))
        b = bal.withColumn("_qk", normalize_quarter("quarter")).drop("quarter")
        joined = o.join(b, "_qk", "left").drop("_qk")
    return add_year_quarter(joined)


def attach(base: DataFrame, source: DataFrame | None, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """LEFT join a many-to-one source; a missing source gives
    typed NULL columns instead of a join."""
    if source is None:
        return base.withColumns({c: F.lit(None).cast("double") for c in value_cols})
    return base.join(source.select(*keys, *value_cols), list(keys), "left")


def enrich_rates(base: DataFrame, default_q: DataFrame | None, prime_q: DataFrame | None,
                 lending_y: DataFrame | None) -> DataFrame:
    """Default rate by (year, quarter_num), prime by quarter_key, lending by
    year (annual value on every quarter of the year)."""
    out = attach(base, default_q, ["year", "quarter_num"], ["default_rate"])
    out = attach(out, prime_q, ["quarter_key"], ["prime_rate"])
    return attach(out, lending_y, ["year"], ["lending_rate"])


def fanout_report(left: DataFrame, right: DataFrame, keys: Sequence[str], label: str, how: str = "left") -> DataFrame:
    """Rows before and after a join, ratio and warning flag, without
    running the join itself.

    Both sides are reduced to per-key row counts (partial aggregation), so the
    cost is two aggregations even when the real join would explode.  The
    product of counts is taken in DECIMAL(38,0) so a hot many-to-many key
    cannot overflow.  No warning is raised when the left side is empty.
    """
    keys = list(keys)
    if how not in ("left", "inner"):
        raise ValueError(f"fan-out check supports left and inner joins, not {how}")
    lc = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ln"))
    rc = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rn"))
    # Every left key survives the LEFT join, so one pass gives both totals.
    j = lc.join(rc, keys, "left")
    ln = F.col("_ln").cast("decimal(38,0)")
    rn = F.col("_rn").cast("decimal(38,0)")
    mult = F.coalesce(rn, F.lit(1).cast("decimal(38,0)")) if how == "left" else F.coalesce(rn, F.lit(0).cast("decimal(38,0)"))
    totals = j.agg(
        F.coalesce(F.sum("_ln"), F.lit(0).cast("bigint")).alias("before_rows"),
        F.coalesce(F.sum(ln * mult), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("after_rows"),
    )
    ratio = F.when(F.col("before_rows") > 0, F.col("after_rows").cast("double") / F.col("before_rows").cast("double"))
    return totals.select(
        F.lit(label).alias("label"),
        "before_rows",
        "after_rows",
        ratio.alias("ratio"),
        F.coalesce(ratio > F.lit(FANOUT_LIMIT), F.lit(False)).alias("fanout_warn"),
    )
