"""Old files read to the contract, keys repaired, footers asked."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import rows
from ledgerloom import contracts as C
from ledgerloom.operators import evolve, footers, reports
from ledgerloom.operators import warehouse as W


def test_widening_rules():
    i, b, s, d = T.IntegerType(), T.LongType(), T.ShortType(), T.DecimalType
    assert evolve.widens(s, i) and evolve.widens(i, b) and not evolve.widens(b, i)
    assert evolve.widens(d(10, 2), d(18, 2)) and evolve.widens(d(6, 3), d(8, 5)) and not evolve.widens(d(18, 2), d(18, 4))
    assert evolve.widens(i, d(12, 2)) and not evolve.widens(b, d(18, 2)) and not evolve.widens(T.StringType(), i)


def test_generations_meet_in_the_contract(spark, tmp):
    contract = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("amt", T.DecimalType(8, 2)), T.StructField("note", T.StringType())])
    spark.createDataFrame([(1, 5), (2, None)], "k smallint, amt int").write.parquet(tmp + "/a")
    spark.createDataFrame([(3, Decimal("1.239"), "x"), (1 << 40, Decimal("2.500"), "y"), (4, Decimal("9999999.100"), "z")], "k bigint, amt decimal(12,3), old string").write.parquet(tmp + "/b")
    spark.createDataFrame([(5, Decimal("7.25"), "n")], contract).write.parquet(tmp + "/c")
    got, lost = evolve.read_generations(spark, [tmp + "/a", tmp + "/b", tmp + "/c"], contract, ["k"])
    assert got.columns == ["k", "amt", "note", "old"] and [got.schema[f.name].dataType for f in contract] == [f.dataType for f in contract]
    assert rows(got) == sorted([(1, Decimal("5.00"), None, None), (2, None, None, None), (3, None, None, "x"), (None, Decimal("2.50"), None, "y"),
                                (4, None, None, "z"), (5, Decimal("7.25"), "n", None)], key=repr)
    assert rows(lost, "k", "dq_reason") == sorted([(3, "amt_out_of_contract"), (4, "amt_out_of_contract"), (None, "k_out_of_contract")], key=repr)
    none, rejects = evolve.read_generations(spark, [], contract, ["k"])
    assert none.count() == 0 and rejects is None


def test_unique_key_repair_moves_the_facts(spark):
    dim = spark.createDataFrame([(7, "a", None), (3, "a", None), (9, "a", None), (4, "b", "t"), (5, None, None)], "product_key int, product_code string, product_type string")
    kept, losers = evolve.repair_unique(dim, ["product_code", "product_type"], "product_key", "uq_prod")
    assert rows(kept, "product_key") == [(3,), (4,), (5,)]
    assert rows(losers) == [(7, 3, "uq_prod"), (9, 3, "uq_prod")]
    facts = spark.createDataFrame([(1, 7), (2, 9), (3, 4), (4, None), (5, 3)], "q int, product_key int")
    assert rows(evolve.move_keys(facts, losers, "product_key")) == [(1, 3), (2, 3), (3, 4), (4, None), (5, 3)]


def test_counts_and_ranges_come_from_footers(spark, tmp):
    wh = W.Warehouse(spark, tmp)
    wh.create_tables_if_missing()
    ranges = {"dim_date_qtr": "year", "fact_credit_metrics_qtr": "originations_cnt"}
    assert rows(footers.table_stats(wh, ranges)) == [("dim_date_qtr", 0, None, None), ("fact_credit_metrics_qtr", 0, None, None)]
    d = dt.date(2012, 1, 1)
    with wh.load():
        wh._write(spark.createDataFrame([(20123, 2012, 3, d, d), (20131, 2013, 1, d, d)], C.DIM_DATE_QTR), "dim_date_qtr", static=True)
        wh._write(spark.createDataFrame([(20123, 1, 1, 5, None, None, None, None, None), (20131, 1, 1, 9, None, None, None, None, None)], C.FACT_CREDIT_METRICS_QTR), "fact_credit_metrics_qtr")
    stats = footers.table_stats(wh, ranges)
    assert rows(stats) == [("dim_date_qtr", 2, 2012, 2013), ("fact_credit_metrics_qtr", 2, 5, 9)]
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*), MIN") == 2 or plan.count("PushedAggregation") >= 2, plan
    with pytest.raises(ValueError, match="footers do not bound"):
        footers.footer_stats(footers.footer_session(spark), [tmp], C.FACT_CREDIT_METRICS_QTR, ["balance_amt"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_run_report_document_round_trip(spark, tmp):
    base = spark.createDataFrame([(2012, 20123, 5, 1.0, None, 0.5, 3.0, None), (2012, 20123, -5, 1.0, 2.0, 1.5, None, None)],
                                 "year int, quarter_key int, originations_cnt bigint, origination_amt double, balance_amt double, default_rate double, prime_rate double, lending_rate double")
    for n, frame in (("full", base), ("empty", base.limit(0))):
        reports.write_document(reports.run_document(reports.run_report(frame, {"orig_rows": frame, "bal_rows": None})), f"{tmp}/{n}")
        reports.write_document(reports.validation_document(frame), f"{tmp}/{n}-v")
    doc = reports.read_document(spark, tmp + "/full").first()
    assert doc.sources == {"orig_rows": 2, "bal_rows": 0} and doc.coverage.rows_after_merge == 2 and doc.dupes_on_quarter_key == 1
    assert tuple(doc.null_profile["balance_amt"]) == (1, 1, 50.0) and doc.violations["neg_originations_cnt"] == 1 and doc.generated_at.endswith("Z")
    none = reports.read_document(spark, tmp + "/empty").first()
    assert none.coverage is None and none.sources["orig_rows"] == 0 and none.null_profile["prime_rate"]["null_pct"] == 0.0
    check = reports.read_document(spark, tmp + "/full-v", reports.VALIDATION_DOCUMENT).first()
    assert check.rows == 2 and check.null_rates["lending_rate"] == 1.0 and check.range_bad_default == 1
