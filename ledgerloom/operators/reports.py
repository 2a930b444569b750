"""Run reports and validation snapshots.

Every report is a small DataFrame computed with one aggregation over its
input; the sinks write them as JSON / CSV folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import MEASURES
from ..functions.money import pct, ratio_half_up
from ..functions.text import utc_now_iso
from .warehouse import table_counts


def source_counts(sources: dict[str, DataFrame | None], counted: str | None = None) -> DataFrame:
    """Rows per source, 0 for an absent one; ``(source, rows)``.  A frame
    with the column ``counted`` stands for that many rows each: a source that
    was aggregated on the way in is not read again to be counted."""
    out = None
    for name, df in sources.items():
        if df is None:
            continue
        n = F.coalesce(F.sum(counted), F.lit(0)).cast("bigint") if counted in df.columns else F.count(F.lit(1))
        one = df.agg(n.alias("rows")).select(F.lit(name).alias("source"), "rows")
        out = one if out is None else out.unionByName(one)
    absent = [n for n, df in sources.items() if df is None]
    if absent:
        spark = next(df for df in sources.values() if df is not None).sparkSession
        zeros = spark.createDataFrame([(n, 0) for n in absent], "source string, rows bigint")
        out = zeros if out is None else out.unionByName(zeros)
    return out


def coverage(base: DataFrame) -> DataFrame:
    """R2: year and quarter-key range and row count; no row when empty."""
    return base.agg(
        F.min("year").cast("int").alias("min_year"),
        F.max("year").cast("int").alias("max_year"),
        F.min("quarter_key").cast("int").alias("min_quarter_key"),
        F.max("quarter_key").cast("int").alias("max_quarter_key"),
        F.count(F.lit(1)).alias("rows_after_merge"),
    ).where(F.col("rows_after_merge") > 0)


def null_profile(base: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """Per column non-null / null counts and null percent (2 places)."""
    cols = [c for c in cols if c in base.columns]
    agg = base.agg(F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(c) for c in cols])
    long = agg.unpivot(["_total"], cols, "column_name", "non_null")
    return long.select(
        "column_name",
        "non_null",
        (F.col("_total") - F.col("non_null")).alias("null"),
        pct(F.col("_total") - F.col("non_null"), F.col("_total")).alias("null_pct"),
    )


def violations(base: DataFrame) -> DataFrame:
    """Rule violations, one row per rule (run it on the pre-gate base
    too: after the gates they are 0 by construction)."""
    rules = {}
    if "default_rate" in base.columns:
        rules["default_rate_out_of_range"] = (F.col("default_rate") < 0) | (F.col("default_rate") > 1)
    for c in ("originations_cnt", "origination_amt", "balance_amt"):
        if c in base.columns:
            rules[f"neg_{c}"] = F.col(c) < 0
    agg = base.agg(*[F.count_if(F.coalesce(e, F.lit(False))).alias(k) for k, e in rules.items()])
    return agg.unpivot([], list(rules), "rule", "violations")


def dup_keys(base: DataFrame, keys: Sequence[str] = ("quarter_key",)) -> DataFrame:
    """How many keys occur more than once."""
    per_key = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return per_key.agg(F.count_if(F.col("c") > 1).alias("dupes_on_quarter_key"))


def validate_report(base: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """Rows, NULL rate per measure (3 places), out-of-range default rate."""
    cols = [c for c in cols if c in base.columns]
    n = F.count(F.lit(1))
    parts = [n.alias("rows")]
    parts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    if "default_rate" in base.columns:
        d = F.col("default_rate")
        parts.append(F.count_if(~(d.between(0, 1) | d.isNull())).alias("range_bad_default"))
    else:
        parts.append(F.lit(0).cast("bigint").alias("range_bad_default"))
    agg = base.agg(*parts)
    rate = {f"null_rate_{c}": F.when(F.col("rows") > 0, ratio_half_up(F.col(f"null_{c}"), F.col("rows"), 3))
            for c in cols}
    return agg.select("rows", *[v.alias(k) for k, v in rate.items()], "range_bad_default")


def run_report(base: DataFrame, sources: dict[str, DataFrame | None], counted: str | None = None) -> dict[str, DataFrame]:
    """R1–R6 as named frames (the report is small: written as JSON)."""
    return {
        "sources": source_counts(sources, counted),
        "coverage": coverage(base),
        "null_profile": null_profile(base),
        "violations": violations(base),
        "dupes_on_quarter_key": dup_keys(base),
        "generated_at": base.sparkSession.range(1).select(utc_now_iso().alias("generated_at")),
    }


#: K3: the run report as one document (read back with this schema).
RUN_DOCUMENT = (
    "sources map<string,bigint>, "
    "coverage struct<min_year:int,max_year:int,min_quarter_key:int,max_quarter_key:int,rows_after_merge:bigint>, "
    "null_profile map<string,struct<non_null:bigint,null:bigint,null_pct:double>>, "
    "violations map<string,bigint>, dupes_on_quarter_key bigint, generated_at string")
#: K4: the validation snapshot.
VALIDATION_DOCUMENT = "rows bigint, null_rates map<string,double>, range_bad_default bigint"


def _entries(frame: DataFrame, key: str, *values: str) -> Column:
    """A small frame as one map, key → value (or struct of values)."""
    value = F.struct(*values) if len(values) > 1 else F.col(values[0])
    return frame.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), value)))).scalar()


def run_document(frames: dict[str, DataFrame]) -> DataFrame:
    """K3: the report frames of :func:`run_report` as one nested row.  Every
    part is a scalar subquery of a few rows."""
    one = frames["generated_at"].sparkSession.range(1)
    cover = frames["coverage"]
    return one.select(
        _entries(frames["sources"], "source", "rows").alias("sources"),
        cover.agg(F.first(F.struct(*cover.columns))).scalar().alias("coverage"),
        _entries(frames["null_profile"], "column_name", "non_null", "null", "null_pct").alias("null_profile"),
        _entries(frames["violations"], "rule", "violations").alias("violations"),
        frames["dupes_on_quarter_key"].scalar().alias("dupes_on_quarter_key"),
        frames["generated_at"].scalar().alias("generated_at"))


def validation_document(base: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """K4: :func:`validate_report` with its rates as one map."""
    flat = validate_report(base, cols)
    rates = [c for c in flat.columns if c.startswith("null_rate_")]
    pairs = F.map_from_entries(F.array(*[F.struct(F.lit(c[len("null_rate_"):]).alias("key"), F.col(c).alias("value")) for c in rates]))
    return flat.select("rows", pairs.alias("null_rates"), "range_bad_default")


def write_document(document: DataFrame, path: str) -> None:
    """One JSON file with the whole document, over an earlier one."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_document(spark: SparkSession, path: str, schema: str = RUN_DOCUMENT) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_reports(frames: dict[str, DataFrame], out_dir: str) -> None:
    """K3 / K4: each report frame as a one-file JSON folder."""
    for name, df in frames.items():
        df.coalesce(1).write.mode("overwrite").json(f"{out_dir}/{name}")


def write_rejects(rejects: DataFrame | None, out_dir: str) -> DataFrame | None:
    """K1 + K2: all rejects as CSV (always written, so an empty run clears
    the previous file) and a per-reason summary as JSON."""
    from .quality import reject_summary

    if rejects is None:
        return None
    rejects.write.mode("overwrite").option("header", True).csv(f"{out_dir}/rejects")
    summary = reject_summary(rejects)
    summary.coalesce(1).write.mode("overwrite").json(f"{out_dir}/dq_summary")
    return summary


__all__ = [
    "coverage", "dup_keys", "null_profile", "read_document", "run_document", "run_report", "validation_document", "write_document", "source_counts", "table_counts",
    "validate_report", "violations", "write_rejects", "write_reports",
]
