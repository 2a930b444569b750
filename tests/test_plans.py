"""Plan guards for every catalogue query: the properties that matter at
scale, checked on the physical plans Spark produces."""

import pytest

import __spark_entry__ as E

from ledgerloom.plans import catalog

NAMES = sorted(catalog.QUERIES)
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {n: _plan(E.queries()[n](spark, sf_small)) for n in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_no_python(plans, name):
    plan = plans[name]
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_scans_are_pruned(plans):
    # The line-item scans of the star never read the columns the star
    # does not use.
    for name in ("fact_build", "trend", "yearly"):
        for line in plans[name].splitlines():
            if "lineitem.parquet" in line and "ReadSchema" in line:
                assert "l_returnflag" not in line and "l_quantity" not in line, line


def test_filters_reach_the_scan(spark, sf_small):
    from pyspark.sql import functions as F
    from ledgerloom.plans import star

    li = star.table(spark, sf_small, "lineitem").where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    plan = _plan(li.select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in plan


def test_keep_first_aggregates_partially(plans):
    # a hot key shrinks to one row per task before the shuffle
    assert "partial_min" in plans["dedupe_keep_first"]
    assert "Window" not in plans["dedupe_keep_first"]


def test_fill_windows_the_data_once(plans):
    plan = plans["ffill_in_group"]
    # one window over the rows, one over the per-segment summary
    assert plan.count("Window [") == 2
    assert "BroadcastHashJoin" in plan


def test_fanout_never_joins_raw_rows(plans):
    # every join input of the fan-out check is an aggregate of per-key counts
    plan = plans["fanout_guard"]
    assert "partial_count" in plan
    assert "CartesianProduct" not in plan


def test_marts_need_no_surrogate_keys(spark, sf_small):
    # The rollups read the keyless measure rows; they equal the rollups of
    # the keyed fact, and their plans hold no key numbering window.
    from conftest import rows
    from ledgerloom.plans import marts, star

    dd = star.date_dim(spark, sf_small)
    keyed = star.fact_rows(spark, sf_small)
    keyless = star.fact_measures(spark, sf_small)
    assert keyless.count() == keyed.count()
    for mart in (marts.trend, marts.yearly):
        assert rows(mart(keyless, dd)) == rows(mart(keyed, dd))
    for name in ("trend", "yearly"):
        assert "Window [" not in plans_of(spark, sf_small, name)


def plans_of(spark, sf, name):
    return _plan(E.queries()[name](spark, sf))


def test_parquet_schema_resolved_once(spark, sf_small):
    from ledgerloom.sources.tables import read_parquet

    path = f"{sf_small}/nation.parquet"
    first = read_parquet(spark, path)
    sc = spark.sparkContext
    sc.setJobGroup("schema-once", "schema-once")
    again = read_parquet(spark, path)
    assert again.schema == first.schema
    assert sc.statusTracker().getJobIdsForGroup("schema-once") == []
    sc.setJobGroup("other", "other")


def test_queries_leave_the_session_settings_alone(spark, sf_small):
    before = dict(spark.conf.getAll)
    for name in ("trend", "fact_build", "ffill_in_group", "geo_keys"):
        E.queries()[name](spark, sf_small).count()
    assert dict(spark.conf.getAll) == before


def test_faulty_base_exercises_every_gate(spark, sf_small):
    found = {r.rule: r.violations for r in E.queries()["violations"](spark, sf_small).collect()}
    assert all(found.values()) and len(found) == 4
    assert E.queries()["dup_keys"](spark, sf_small).first()[0] > 0
    rates = E.queries()["null_rates"](spark, sf_small).first().asDict()
    assert rates["null_rate_prime_rate"] > 0 and rates["range_bad_default"] > 0
    gated = E.queries()["member_gated_base"](spark, sf_small)
    assert gated.where("lending_rate is null").count() > 0  # leading gaps stay
    from ledgerloom.plans import star
    base = star.member_base(spark, sf_small)
    assert gated.where("lending_rate is null").count() < base.where("lending_rate is null").count()
    assert gated.groupBy("member", "quarter_key").count().where("count > 1").isEmpty()


def _scans(plan: str, table: str) -> int:
    return plan.count(f"/{table}.parquet]")


def test_big_tables_scanned_once_per_need(plans):
    # The keyed star reads its materialised cells (with their rate sums),
    # never the line items again.
    for name in ("fact_build", "fact_upsert", "fact_recreate"):
        assert _scans(plans[name], "lineitem") == 0, name
    # Marts: one big pass; the yearly prime rate adds one tax scan (both
    # rates come from one aggregate per ship year).
    assert _scans(plans["trend"], "lineitem") == 1
    assert _scans(plans["yearly"], "lineitem") == 2
    # The enriched base: its four line-item series come from one pass, which
    # is written once; source_counts and fanout_guard also count rows.
    for name in ("enrich_rates", "gated_base", "pipeline_fact", "coverage", "missing_source"):
        assert _scans(plans[name], "lineitem") == 0, name
    for name in ("null_profile", "null_rates", "violations", "dup_keys", "not_null_violations", "member_gated_base",
                 "source_counts", "fanout_guard"):
        assert _scans(plans[name], "lineitem") == 1, name
    # Fill: the segmented rows are written once; both uses read that.
    assert _scans(plans["ffill_in_group"], "events") == 0
    # Upsert example: the date dimension is materialised once.
    assert _scans(plans["dim_upsert"], "orders") == 0
