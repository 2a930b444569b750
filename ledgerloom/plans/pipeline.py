"""The end-to-end quarterly load.

extract → uniqueness gates → J1 + quarter columns → rate enrichment with
fan-out checks → range / non-negative gates → forward fill within the year
→ final grain dedupe → reports → (unless dry run) star-schema load →
table counts → optional yearly query.

Every source is read in one aggregate, written once with a row per key: its
first rows, its rejects and its row count (R1) come from there, so neither the
reports nor the rejects go back to the files.  (Counts of ``DataFrame.observe``
would be as cheap, but a task repeated after a lost executor adds to them
twice.)  The gated base is checkpointed once: the reports R2–R5, the fan-out
checks, the date dimension and the fact all read it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.money import cast_measure
from ..functions.quarter import normalize_quarter
from ..operators import enrich, fill, quality, reports
from ..operators.warehouse import Warehouse
from ..session import configure, ensure_checkpoint_dir
from ..sources import csv_files, records, series
from . import marts


@dataclass
class Sources:
    """Input locations; any of them may be absent."""
    originations: str | None = None
    balances: str | None = None
    prime_series: str | None = None
    default_series: str | None = None
    lending_records: str | None = None
    series_format: str = "csv"
    lending_country: str = C.DEFAULT_LENDING_COUNTRY


@dataclass
class RunResult:
    base: DataFrame
    rejects: DataFrame | None
    reports: dict[str, DataFrame]
    fanout: DataFrame
    counts: DataFrame | None = None
    timings: dict[str, float] = field(default_factory=dict)


def gate_and_fill(base: DataFrame, member_keys: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Q3 + Q4 + Q5 + Q6 on the enriched base: reject and NULL bad values,
    fill prime / lending within the year, keep one row per grain key.
    ``order`` tells rows of one grain key apart, the first one wins."""
    rejects = []
    if "default_rate" in base.columns:
        base, rej = quality.range_gate(base, "default_rate", 0.0, 1.0, "default_rate_out_of_range",
                                       ["year", "quarter_num", "default_rate"])
        rejects.append(rej)
    base, rej = quality.nonneg_gate(base)
    rejects.append(rej)
    members = [k for k in member_keys if k in base.columns]
    fill_cols = [c for c in C.FILL_COLUMNS if c in base.columns]
    if fill_cols:
        # A group is one year of one member: at most four quarters.
        base = fill.forward_fill(base, fill_cols, members + ["year"], ["quarter_num", "quarter_key", *order],
                                 split_hot_groups=False)
    base = quality.keep_first(base, members + ["quarter_key"], ["year", "quarter_num", *order])
    return base, quality.union_rejects(*rejects)


def build_base(spark: SparkSession, src: Sources):
    """Extract, gate uniqueness, join and enrich.  Returns (base, rejects,
    fan-out report, the extracted sources by report name, the joined rows
    before their uniqueness gate)."""
    orig = csv_files.extract_origination(spark, src.originations) if src.originations else None
    bal = csv_files.extract_balances(spark, src.balances) if src.balances else None
    if orig is None:
        raise FileNotFoundError(f"originations source not found: {src.originations}")
    if bal is None:
        bal = csv_files.empty_frame(spark, f"quarter string, {csv_files.LINE} bigint, balance_amt double")
    prime_s = series.read_series(spark, src.prime_series, src.series_format) if src.prime_series else None
    dflt_s = series.read_series(spark, src.default_series, src.series_format) if src.default_series else None
    prime = enrich.prime_quarterly(prime_s) if prime_s is not None else None
    dfltq = enrich.default_quarterly(dflt_s) if dflt_s is not None else None
    recs = records.read_xml_records(spark, src.lending_records) if src.lending_records else None
    lendy = records.lending_yearly(recs, src.lending_country, keep_position=True) if recs is not None else None

    rejects = []
    # One row per quarter, whatever its layout: the first of the file.
    orig_u, r, orig = _first_per_quarter(orig, "orig"); rejects += r
    bal_u, r, bal = _first_per_quarter(bal, "bal"); rejects += r
    bal_u = bal_u.drop(csv_files.LINE)
    if prime is not None:
        prime, r = quality.ensure_unique_once(prime, ["quarter_key"], ["year"], "prime"); rejects.append(r)
    if dfltq is not None:
        dfltq, r = quality.ensure_unique_once(dfltq, ["year", "quarter_num"], ["default_rate"], "dfltq"); rejects.append(r)
    if lendy is not None:
        lendy, r = quality.ensure_unique_once(lendy, ["year"], [records.POSITION], "lendy"); rejects.append(r)
        lendy = lendy.drop(records.POSITION)

    joined = enrich.join_balances(orig_u, bal_u)
    base, r = quality.ensure_unique(joined, ["quarter_key"], [csv_files.LINE], "base_add_year"); rejects.append(r)
    base = base.drop(csv_files.LINE)
    # One row per quarter (bounded by the calendar), read by every fan-out
    # check and by the enrichment: materialise it so the sources are read once.
    ensure_checkpoint_dir(spark)
    base = base.checkpoint(eager=True)
    fanouts = []
    if dfltq is not None:
        fanouts.append(enrich.fanout_report(base, dfltq, ["year", "quarter_num"], "default_q"))
    if prime is not None:
        fanouts.append(enrich.fanout_report(base, prime, ["quarter_key"], "prime"))
    if lendy is not None:
        fanouts.append(enrich.fanout_report(base, lendy, ["year"], "lending"))
    base = enrich.enrich_rates(base, dfltq, prime, lendy)
    fanout = fanouts[0] if fanouts else spark.createDataFrame(
        [], "label string, before_rows bigint, after_rows decimal(38,0), ratio double, fanout_warn boolean")
    for f in fanouts[1:]:
        fanout = fanout.unionByName(f)
    sources = {"orig_rows": orig, "bal_rows": bal, "prime_rows": prime, "dfltq_rows": dfltq, "lendy_rows": lendy}
    return base, quality.union_rejects(*rejects), fanout, sources, joined


#: Rows behind each row of a counted source.
ROWS = "_rows"


def _first_per_quarter(rows: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Q2 on the normalised quarter; rows without one (footers) go, and rows
    with surplus fields (their values may be shifted) are rejected as they
    stand.  One pass: ``(first rows, rejects, the counted rows for R1)``."""
    ensure_checkpoint_dir(rows.sparkSession)
    token = normalize_quarter("quarter")
    surplus = F.coalesce(F.col(csv_files.SURPLUS), F.lit(False)) & token.isNotNull() if csv_files.SURPLUS in rows.columns else F.lit(False)
    keyed = rows.withColumns({"_token": token, "_long": F.when(surplus, F.col("quarter"))}).drop(csv_files.SURPLUS)
    counted = quality.keep_first(keyed, ["_token", "_long"], [csv_files.LINE], count_as=ROWS).checkpoint(eager=True)
    good = counted.where("_long IS NULL")
    named = good.where("_token IS NOT NULL")
    rejects = [quality.copies_as_rejects(counted.where("_long IS NOT NULL").withColumn("quarter", F.col("_long")), ROWS, ["quarter"], "row_too_long"),
               quality.copies_as_rejects(named.withColumn("quarter", F.col("_token")), F.col(ROWS) - 1, ["quarter"], f"{name}_duplicate_keys")]
    return named.drop("_token", "_long", ROWS), rejects, good


def fact_from_base(base: DataFrame, geo_key: DataFrame, product_key: DataFrame) -> DataFrame:
    """Stamp the single geo / product key and cast the measures."""
    # Both key frames hold exactly one row: scalar subqueries, no join.
    stamped = base.withColumns({"geo_key": geo_key.select("geo_key").scalar().cast("int"),
                                "product_key": product_key.select("product_key").scalar().cast("int")})
    return stamped.select("quarter_key", "geo_key", "product_key", *[cast_measure(m, m) for m in C.MEASURES])


def run(spark: SparkSession, src: Sources, warehouse_root: str, report_dir: str | None = None,
        recreate: bool = False, validate: bool = False, dry_run: bool = False,
        perfcheck: bool = False) -> RunResult:
    """The whole load.  Idempotent: running it twice leaves the same tables."""
    configure(spark)
    t0 = time.time()
    base, rejects, fanout, sources, joined = build_base(spark, src)
    before = base
    base, gate_rejects = gate_and_fill(base)
    base, load_rejects = quality.precision_gate(base)
    rejects = quality.union_rejects(rejects, gate_rejects, load_rejects)
    # Several actions read the gated base: materialise it once.
    base = base.checkpoint(eager=True)
    reps = reports.run_report(base, sources, ROWS)
    # What the gates and the dedupe found, which is gone behind them.
    reps["violations_before_gates"] = reports.violations(before)
    reps["dupes_before_dedupe"] = reports.dup_keys(joined)
    if validate:
        reps["validate"] = reports.validate_report(base)
    if report_dir:
        reports.write_rejects(rejects, report_dir)
        reports.write_reports(reps, report_dir)
        reports.write_document(reports.run_document(reps), f"{report_dir}/run_report")
        if validate:
            reports.write_document(reports.validation_document(base), f"{report_dir}/validation")
        fanout.coalesce(1).write.mode("overwrite").json(f"{report_dir}/fanout")
    result = RunResult(base=base, rejects=rejects, reports=reps, fanout=fanout)
    result.timings["transform"] = time.time() - t0
    if dry_run:
        return result

    wh = Warehouse(spark, warehouse_root)
    # All tables of the load appear at once, or none.
    with wh.load():
        wh.create_tables_if_missing()
        dim_rows = base.select("quarter_key", "year", F.col("quarter_num").alias("quarter"),
                               "quarter_start", "quarter_end").distinct()
        wh.upsert_dim_date(dim_rows)
        geo = wh.get_or_create("dim_geo", spark.createDataFrame([C.DEFAULT_GEO], "country string, state_province string, city string"))
        prod = wh.get_or_create("dim_product", spark.createDataFrame([C.DEFAULT_PRODUCT], "product_code string, product_type string, segment string"))
        geo_row = geo.where(F.col("country").eqNullSafe(C.DEFAULT_GEO[0]) & F.col("state_province").isNull()
                            & F.col("city").isNull()).agg(F.min("geo_key").alias("geo_key"))
        prod_row = prod.where(F.col("product_code").eqNullSafe(C.DEFAULT_PRODUCT[0])
                              & F.col("product_type").eqNullSafe(C.DEFAULT_PRODUCT[1])
                              & F.col("segment").eqNullSafe(C.DEFAULT_PRODUCT[2])).agg(F.min("product_key").alias("product_key"))
        fact = fact_from_base(base, geo_row, prod_row)
        late = wh.recreate_fact(fact) if recreate else wh.upsert_fact(fact)
    result.rejects = quality.union_rejects(rejects, late)
    if report_dir:
        reports.write_rejects(result.rejects, report_dir)
    result.counts = wh.counts()
    result.timings["load"] = time.time() - t0
    if perfcheck:
        t1 = time.time()
        marts.yearly(wh.read("fact_credit_metrics_qtr"), wh.read("dim_date_qtr")).collect()
        result.timings["perfcheck"] = time.time() - t1
    return result
