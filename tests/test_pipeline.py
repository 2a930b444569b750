import os
from decimal import Decimal

import pytest

from ledgerloom.operators.warehouse import Warehouse
from ledgerloom.plans import marts, pipeline
from conftest import rows
from fixtures import bal_csv, lending_xml, orig_csv, series_csv


def _sources(tmp):
    orig = [("2012Q3", "55.00", "14.22"), ("Q4 2012", "63.94", "17.45"), ("2013Q1", "-1.00", "8.62"),
            ("2013Q2", "71.00", "11.00"), ("2013Q2", "70.00", "10.00")]
    bal = [("2012Q3", "578.17"), ("2012Q4", "594.64"), ("2013Q1", "600.00"), ("2013Q2", "610.00")]
    prime = [("2012-07-02", "3.25"), ("2012-08-01", "3.75"), ("2013-04-02", "3.25")]
    dflt = [("2012-07-01", "4.5"), ("2012-10-01", "150"), ("2013-01-01", "4.0"), ("2013-04-01", "3.9")]
    lend = [[("Country or Area", "United States"), ("Year", "2012"), ("Value", "3.25")]]
    return pipeline.Sources(
        originations=orig_csv(tmp + "/src/orig.csv", orig), balances=bal_csv(tmp + "/src/bal.csv", bal),
        prime_series=series_csv(tmp + "/src/prime.csv", prime),
        default_series=series_csv(tmp + "/src/delinquency.csv", dflt, "DELINQUENCY"),
        lending_records=lending_xml(tmp + "/src/lend/wb.xml", lend))


def test_end_to_end_load(spark, tmp):
    src = _sources(tmp)
    res = pipeline.run(spark, src, tmp + "/wh", report_dir=tmp + "/rep", validate=True)
    base = {r.quarter_key: r for r in res.base.collect()}
    assert sorted(base) == [20123, 20124, 20131, 20132]
    # duplicate 2013Q2 row: the first in order is kept and one reject recorded
    reasons = sorted(r.dq_reason for r in res.rejects.collect())
    assert reasons == ["default_rate_out_of_range", "negative_origination_amt", "orig_duplicate_keys"]
    assert base[20124].default_rate is None              # 150 % rejected then NULLed
    assert base[20123].prime_rate == pytest.approx(3.5)
    assert base[20124].prime_rate == pytest.approx(3.5)   # filled within 2012
    assert base[20131].prime_rate is None                 # never crosses the year
    assert base[20123].lending_rate == pytest.approx(3.25) and base[20132].lending_rate is None
    assert base[20131].origination_amt is None
    assert base[20132].origination_amt == 71e9            # first row of the file wins
    counts = dict((r.table_name, r.cnt) for r in res.counts.collect())
    assert counts == {"dim_date_qtr": 4, "dim_geo": 1, "dim_product": 1, "fact_credit_metrics_qtr": 4}
    assert os.path.isdir(tmp + "/rep/rejects") and os.path.isdir(tmp + "/rep/coverage")
    fan = {r.label: r.fanout_warn for r in res.fanout.collect()}
    assert fan == {"default_q": False, "prime": False, "lending": False}
    first = rows(Warehouse(spark, tmp + "/wh").read("fact_credit_metrics_qtr"))
    # idempotent: a second run leaves the same tables
    pipeline.run(spark, src, tmp + "/wh")
    assert rows(Warehouse(spark, tmp + "/wh").read("fact_credit_metrics_qtr")) == first
    assert dict((r.table_name, r.cnt) for r in res.counts.collect())["dim_geo"] == 1


def test_dry_run_writes_nothing(spark, tmp):
    res = pipeline.run(spark, _sources(tmp), tmp + "/wh", dry_run=True)
    assert res.counts is None and not os.path.exists(tmp + "/wh")
    assert res.base.count() == 4


# The two quarterly source files with 51 quarters each (2012Q3–2025Q1);
# their totals are listed in FIXTURES.md §4.
GOLDEN_ORIG = os.environ.get("LEDGERLOOM_GOLDEN_ORIG", "")
GOLDEN_BAL = os.environ.get("LEDGERLOOM_GOLDEN_BAL", "")


@pytest.mark.skipif(not (os.path.isfile(GOLDEN_ORIG) and os.path.isfile(GOLDEN_BAL)),
                    reason="set LEDGERLOOM_GOLDEN_ORIG / LEDGERLOOM_GOLDEN_BAL to the source files")
def test_golden_totals_on_source_files(spark, tmp):
    src = pipeline.Sources(originations=GOLDEN_ORIG, balances=GOLDEN_BAL)
    res = pipeline.run(spark, src, tmp + "/wh")
    srcs = dict((r.source, r.rows) for r in res.reports["sources"].collect())
    assert srcs == {"orig_rows": 54, "bal_rows": 54, "prime_rows": 0, "dfltq_rows": 0, "lendy_rows": 0}
    cov = res.reports["coverage"].first()
    assert (cov.min_year, cov.max_year, cov.min_quarter_key, cov.max_quarter_key, cov.rows_after_merge) == (
        2012, 2025, 20123, 20251, 51)
    counts = dict((r.table_name, r.cnt) for r in res.counts.collect())
    assert counts == {"dim_date_qtr": 51, "dim_geo": 1, "dim_product": 1, "fact_credit_metrics_qtr": 51}
    wh = Warehouse(spark, tmp + "/wh")
    fact, dd = wh.read("fact_credit_metrics_qtr"), wh.read("dim_date_qtr")
    yearly = {r.year: (r.cnt, r.amt) for r in marts.yearly(fact, dd).collect()}
    assert yearly[2012] == (31670000, Decimal("118940000000.00"))
    assert yearly[2024] == (69250000, Decimal("412030000000.00"))
    assert sum(v[0] for v in yearly.values()) == 895920000
    assert sum(v[1] for v in yearly.values()) == Decimal("4153770000000.00")
    bal = {r.year: r.balance_usd for r in marts.trend(fact, dd).groupBy("year").agg({"balance_usd": "sum"})
           .withColumnRenamed("sum(balance_usd)", "balance_usd").collect()}
    assert sum(bal.values()) == Decimal("35466360000000.00")
    row = {r.quarter_key: r for r in fact.collect()}
    assert (row[20123].originations_cnt, row[20123].origination_amt, row[20123].balance_amt) == (
        14220000, Decimal("55000000000.00"), Decimal("578170000000.00"))
    nulls = {r.column_name: r.null_pct for r in res.reports["null_profile"].collect()}
    assert nulls["prime_rate"] == 100.0 and nulls["origination_amt"] == 0.0


def test_no_valid_quarters_gives_empty_load(spark, tmp):
    from fixtures import write, ORIG_HEADER, FOOTERS
    orig = write(tmp + "/o.csv", "\n".join([ORIG_HEADER, ""] + FOOTERS) + "\n")
    res = pipeline.run(spark, pipeline.Sources(originations=orig), tmp + "/wh", report_dir=tmp + "/rep")
    assert res.base.count() == 0
    assert res.reports["coverage"].count() == 0
    counts = dict((r.table_name, r.cnt) for r in res.counts.collect())
    assert counts["fact_credit_metrics_qtr"] == 0 and counts["dim_geo"] == 1


def test_command_line(tmp, capsys, spark):
    import json as _json
    from ledgerloom.__main__ import main

    src = _sources(tmp)
    main(["--orig", src.originations, "--bal", src.balances, "--warehouse", tmp + "/wh", "--validate", "--perfcheck"])
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["counts"]["fact_credit_metrics_qtr"] == 4 and out["rows_ready"] == 4


def test_every_source_is_scanned_once(spark, tmp):
    """The load and all of its reports and rejects read each CSV source in
    one pass (a series is also read to choose its columns)."""
    src = _sources(tmp)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    pipeline.run(spark, src, tmp + "/wh", report_dir=tmp + "/rep", validate=True)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList(int(before), 10_000)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]

    def scans(path):
        # An adaptive plan is described twice, as planned and as run.
        held = [sum("InMemoryFileIndex" in line and path in line for line in plan.splitlines()) for plan in plans]
        assert max(held) <= 2
        return sum(n > 0 for n in held)

    assert scans("/src/orig.csv") == 1 and scans("/src/bal.csv") == 1
    # A series: its header line (read on its own), its columns, its values.
    assert scans("/src/prime.csv") <= 4 and scans("/src/delinquency.csv") <= 4 and scans("/src/lend/wb.xml") == 1
