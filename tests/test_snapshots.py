"""Atomic loads: nothing half-written is ever read."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from conftest import rows
from ledgerloom import contracts as C
from ledgerloom.operators import warehouse as W
from ledgerloom.operators.snapshots import ConcurrentLoad
from ledgerloom.plans import catalog, marts

FACT = "fact_credit_metrics_qtr"


def dates(spark, *keys):
    d = dt.date(2012, 1, 1)
    return spark.createDataFrame([(k, k // 10, k % 10, d, d) for k in keys], C.DIM_DATE_QTR)


def facts(spark, *cells):
    """(quarter, count) as fact rows of one geo and product member."""
    return spark.createDataFrame([(q, 1, 1, n, Decimal(n), None, None, None, None) for q, n in cells], C.FACT_CREDIT_METRICS_QTR)


def loaded(spark, root, *cells):
    wh = W.Warehouse(spark, root)
    with wh.load():
        wh.create_tables_if_missing()
        wh.upsert_dim_date(dates(spark, *(q for q, _ in cells)))
        wh.get_or_create("dim_geo", spark.createDataFrame([C.DEFAULT_GEO], "country string, state_province string, city string"))
        wh.get_or_create("dim_product", spark.createDataFrame([C.DEFAULT_PRODUCT], "product_code string, product_type string, segment string"))
        wh.upsert_fact(facts(spark, *cells))
    return wh


def counts(wh):
    return rows(wh.read(FACT), "quarter_key", "originations_cnt")


def test_a_load_that_dies_leaves_all_tables_as_they_were(spark, tmp):
    wh = loaded(spark, tmp, (20123, 1), (20124, 2))
    assert wh.snapshots.number() == 1  # four tables, one version
    held = wh.read(FACT)
    with pytest.raises(ZeroDivisionError), wh.load():
        wh.upsert_dim_date(dates(spark, 20124, 20131))
        wh.upsert_fact(facts(spark, (20124, 20), (20131, 30)))
        assert counts(wh) == [(20123, 1), (20124, 20), (20131, 30)]  # the load sees itself
        assert counts(W.Warehouse(spark, tmp)) == [(20123, 1), (20124, 2)]  # nobody else does
        1 / 0
    assert counts(wh) == [(20123, 1), (20124, 2)] and wh.read("dim_date_qtr").count() == 2
    with wh.load():  # the rerun
        wh.upsert_dim_date(dates(spark, 20124, 20131))
        wh.upsert_fact(facts(spark, (20124, 20), (20131, 30)))
    assert counts(wh) == [(20123, 1), (20124, 20), (20131, 30)]
    # A frame of the old version keeps its files; untouched quarters keep theirs.
    assert rows(held, "quarter_key", "originations_cnt") == [(20123, 1), (20124, 2)]
    old, new = (wh.snapshots.tables(n)[FACT] for n in (1, 2))
    assert old["quarter_key=20123"] == new["quarter_key=20123"] and old["quarter_key=20124"] != new["quarter_key=20124"]


def test_of_two_loads_from_one_version_one_is_published(spark, tmp):
    loaded(spark, tmp, (20123, 1))
    a, b = W.Warehouse(spark, tmp), W.Warehouse(spark, tmp)
    with pytest.raises(ConcurrentLoad), a.load():
        a.upsert_fact(facts(spark, (20123, 5)))
        b.upsert_fact(facts(spark, (20123, 7)))
    assert counts(a) == [(20123, 7)] and a.snapshots.number() == 2
    assert not [n for n in os.listdir(tmp + "/_versions") if n.endswith(".draft")]


def test_vacuum_keeps_what_the_last_versions_name(spark, tmp):
    wh = loaded(spark, tmp, (20123, 1), (20124, 2))
    for n in (3, 4, 5):
        wh.upsert_fact(facts(spark, (20124, n)))
    with pytest.raises(ZeroDivisionError), wh.load():
        wh.upsert_fact(facts(spark, (20123, 9)))
        1 / 0
    assert wh.snapshots.vacuum(keep=2) == []  # all of them are young
    gone = wh.snapshots.vacuum(keep=2, older_than_hours=0)
    # The empty tables of the first load, a superseded quarter, and the load that died.
    assert sorted(g.split("/")[0] for g in gone) == ["dim_date_qtr", "dim_geo", "dim_product", FACT, FACT, FACT]
    assert counts(wh) == [(20123, 1), (20124, 5)]
    assert wh.snapshots.number() == 4 and wh.snapshots.tables(3) and not os.path.exists(f"{tmp}/_versions/{2:020d}.json")


def test_a_plain_folder_is_taken_over_partition_by_partition(spark, tmp):
    facts(spark, (20123, 1), (20124, 2)).write.partitionBy("quarter_key").parquet(f"{tmp}/{FACT}")
    dates(spark, 20123, 20124).write.parquet(f"{tmp}/dim_date_qtr")
    wh = W.Warehouse(spark, tmp)
    assert counts(wh) == [(20123, 1), (20124, 2)]
    for name, cols in (("dim_geo", C.DEFAULT_GEO), ("dim_product", C.DEFAULT_PRODUCT)):
        wh.get_or_create(name, spark.createDataFrame([cols], ", ".join(f"{c} string" for c in (C.GEO_NATURAL_KEY if name == "dim_geo" else C.PRODUCT_NATURAL_KEY))))
    wh.upsert_fact(facts(spark, (20124, 7)))
    assert counts(wh) == [(20123, 1), (20124, 7)]


def test_registered_tables_follow_the_published_version(spark, tmp):
    wh = loaded(spark, tmp + "/wh", (20123, 1), (20124, 2))
    db = "follow_" + os.path.basename(tmp).replace("-", "_")
    W.register_tables(spark, wh.root, db)
    sql = f"SELECT quarter_key, originations_cnt FROM `{db}`.{FACT}"
    assert rows(spark.sql(sql)) == [(20123, 1), (20124, 2)]
    with wh.load():
        wh.upsert_dim_date(dates(spark, 20131))
        wh.upsert_fact(facts(spark, (20124, 8), (20131, 3)))
    assert rows(spark.sql(sql)) == [(20123, 1), (20124, 2)]  # still the version it was registered at
    W.register_tables(spark, wh.root, db)
    assert rows(spark.sql(sql)) == [(20123, 1), (20124, 8), (20131, 3)]
    wh.recreate_fact(facts(spark, (20131, 4)))
    W.register_tables(spark, wh.root, db)
    assert rows(spark.sql(sql)) == [(20131, 4)] and spark.table(f"`{db}`.dim_date_qtr").count() == 3


def test_years_prune_partitions_of_the_registered_fact(spark, sf_small):
    df = catalog.QUERIES["trend_sql"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    scan = next(x for x in plan.splitlines() if "FileScan parquet" in x and "origination_amt" in x)
    assert "dynamicpruningexpression(quarter_key" in scan
    assert {r.year for r in df.collect()} and marts.TREND_YEARS_SQL
