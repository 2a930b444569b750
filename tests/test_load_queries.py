"""The catalogue's own source files: how they grow, and how often a line of
them is parsed."""

import datetime

import pytest

from ledgerloom.plans import load_queries, star
from ledgerloom.sources import csv_files, series
from conftest import rows
from fixtures import bal_csv


@pytest.fixture()
def tables(spark, tmp):
    def day(k):
        return datetime.datetime(2012, 1 + k % 12, 1 + k % 28)

    lines = [(k // 3, 100.25 + k % 7 if k % 11 else None, k % 5 / 100, k % 9 / 100 if k % 4 else None, day(k) if k % 13 else None) for k in range(60)]
    li = spark.createDataFrame(lines, "l_orderkey bigint, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp")
    li.repartition(3).write.parquet(tmp + "/lineitem.parquet")
    spark.createDataFrame([(k, 10.5, day(k)) for k in range(20)], "o_orderkey bigint, o_totalprice double, o_orderdate timestamp").write.parquet(tmp + "/orders.parquet")
    return tmp


def test_no_task_gathers_the_daily_series(spark, tables):
    """every scan task writes an export of its own."""
    src = load_queries._load_sources(spark, tables)
    parts = star.table(spark, tables, "lineitem").rdd.getNumPartitions()
    for path, column in ((src.prime_series, "l_tax"), (src.default_series, "l_discount")):
        assert len(csv_files.data_files(spark, path)) == parts > 1
        want = star.percent_series(spark, tables, column).dropna()
        assert rows(series.read_series(spark, path), "date", "value") == rows(want, "date", "value")


@pytest.mark.parametrize("most", [1_000_000, 4])
def test_balance_files_grow_in_number_not_in_rows(spark, tables, monkeypatch, most):
    """more rows make more files, and the same result."""
    made = []
    monkeypatch.setattr(load_queries, "ROWS_A_FILE", most)
    monkeypatch.setattr(load_queries, "_files", lambda lines, name, files, own=load_queries._files: made.append(files) or own(lines, name, files))
    li = star.table(spark, tables, "lineitem").where("l_shipdate IS NOT NULL AND l_extendedprice IS NOT NULL")
    want = li.selectExpr("concat(year(l_shipdate), 'Q', quarter(l_shipdate)) AS quarter", "l_extendedprice * 1e9 AS balance_amt").groupBy("quarter", "balance_amt").count()
    got = load_queries.csv_balances(spark, tables).where("quarter IS NOT NULL AND quarter LIKE '2%'")
    assert rows(got, "quarter", "balance_amt", "n") == rows(want.withColumnRenamed("count", "n"), "quarter", "balance_amt", "n")
    assert made == [8 if most > 60 else 15]


def test_a_line_is_parsed_once_below_a_filter(spark, tmp):
    """a filter on a cleaned value does not parse the line again."""
    path = bal_csv(tmp + "/b.csv", [("2012Q3", " 578.17 "), ("2012Q4", "n/a"), ("2013Q1", "1e999"), ("2013Q2", "600\t")])
    found = csv_files.extract_balances(spark, path).where("balance_amt IS NOT NULL")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert rows(found, "quarter", "balance_amt") == [("2012Q3", 578.17e9), ("2013Q2", 600e9)]
