"""Faults of the source files that the load must survive."""

from decimal import Decimal

from ledgerloom.functions.quarter import normalize_quarter
from ledgerloom.operators import quality
from ledgerloom.operators.warehouse import Warehouse
from ledgerloom.plans import pipeline
from ledgerloom.sources import csv_files
from conftest import rows
from fixtures import BAL_HEADER, ORIG_HEADER, bal_csv, lending_xml, orig_csv, write


def test_first_layout_of_a_quarter_wins_on_both_sides(spark, tmp):
    src = pipeline.Sources(
        originations=orig_csv(tmp + "/o.csv", [("2012Q3", "55.00", "14.22"), ("2012 Q3", "99.00", "1.00")]),
        balances=bal_csv(tmp + "/b.csv", [("2012Q3", "578.17"), ("2012 Q3", "100.00")]))
    res = pipeline.run(spark, src, tmp + "/wh", dry_run=True)
    base = res.base.collect()
    assert [(r.quarter_key, r.origination_amt, r.balance_amt) for r in base] == [(20123, 55e9, 578.17e9)]
    assert sorted(r.dq_reason for r in res.rejects.collect()) == ["bal_duplicate_keys", "orig_duplicate_keys"]


def test_every_file_of_a_folder_keeps_its_own_header(spark, tmp):
    write(tmp + "/in/a.csv", ORIG_HEADER + "\n2012Q3,$55.00,14.22,x,y\n")
    cells = ORIG_HEADER.split(",")
    swapped = ",".join([cells[0], cells[2], cells[1], *cells[3:]])
    write(tmp + "/in/b.csv", "Source: elsewhere\n" + swapped + "\n2012Q4,17.45,$63.94,x,y\n")
    got = rows(csv_files.extract_origination(spark, tmp + "/in"), "quarter", "origination_amt", "originations_cnt")
    assert got == [("2012Q3", 55e9, 14220000), ("2012Q4", 63.94e9, 17450000)]


def test_surplus_fields_are_rejected_not_loaded(spark, tmp):
    orig = write(tmp + "/o.csv", ORIG_HEADER + "\n2012Q3,$55.00,14.22,a,b\n2012Q4,$1,2,3,4,5,6\n")
    res = pipeline.run(spark, pipeline.Sources(originations=orig), tmp + "/wh")
    assert [r.quarter_key for r in res.base.collect()] == [20123]
    assert [(r.quarter, r.dq_reason) for r in res.rejects.collect()] == [("2012Q4", "row_too_long")]


def test_unicode_blanks_around_quarters(spark):
    df = spark.createDataFrame([("\u00a02012Q3\u00a0",), ("Q4\u00a02012",), ("\u2009q1  2013",), ("2012-Q3",)], "q string")
    assert [r[0] for r in df.select(normalize_quarter("q")).collect()] == ["2012Q3", "2012Q4", "2013Q1", None]


def test_first_lending_record_of_a_year_wins(spark, tmp):
    def rec(v):
        return [("Country or Area", "United States"), ("Year", "2012"), ("Value", v)]

    src = pipeline.Sources(originations=orig_csv(tmp + "/o.csv", [("2012Q3", "55.00", "14.22")]),
                           lending_records=lending_xml(tmp + "/l/r.xml", [rec("9"), rec("3")]))
    res = pipeline.run(spark, src, tmp + "/wh", dry_run=True)
    assert [r.lending_rate for r in res.base.collect()] == [9.0]


def test_values_beyond_the_load_types_are_rejected(spark, tmp):
    orig = orig_csv(tmp + "/o.csv", [("2012Q3", "99,999,999,999", "14.22"), ("2012Q4", "1.00", "1.00")])
    lend = lending_xml(tmp + "/l/r.xml", [[("Country or Area", "United States"), ("Year", "2012"), ("Value", "1500")]])
    res = pipeline.run(spark, pipeline.Sources(originations=orig, lending_records=lend), tmp + "/wh")
    found = sorted((r.quarter_key, r.dq_reason) for r in res.rejects.collect())
    assert found == [(20123, "lending_rate_out_of_contract"), (20123, "origination_amt_out_of_contract"), (20124, "lending_rate_out_of_contract")]
    got = {r.quarter_key: r for r in Warehouse(spark, tmp + "/wh").read("fact_credit_metrics_qtr").collect()}
    assert got[20123].origination_amt is None and got[20124].origination_amt == Decimal("1000000000.00")


def test_reports_before_the_gates(spark, tmp):
    src = pipeline.Sources(originations=orig_csv(tmp + "/o.csv", [("2012Q3", "-55.00", "14.22")]))
    res = pipeline.run(spark, src, tmp + "/wh", dry_run=True)
    before = dict((r.rule, r.violations) for r in res.reports["violations_before_gates"].collect())
    after = dict((r.rule, r.violations) for r in res.reports["violations"].collect())
    assert before["neg_origination_amt"] == 1 and after["neg_origination_amt"] == 0
    assert res.reports["dupes_before_dedupe"].first()[0] == 0


def test_last_per_key_keeps_the_latest_row(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 5, "c"), (None, 1, "d"), (None, 2, "e")], "k int, seq int, v string")
    kept, late = quality.last_per_key(df, ["k"], ["seq"], "superseded")
    assert rows(kept) == [(1, 2, None), (2, 5, "c"), (None, 2, "e")]
    assert rows(late) == [(1, "superseded"), (None, "superseded")]


def test_look_alike_of_the_full_source_files(spark, tmp):
    """51 quarters, 16 and 36 columns, footers: counts, coverage and totals."""
    def quarters():
        return [f"{y}Q{q}" for y in range(2012, 2026) for q in range(1, 5) if (2012, 3) <= (y, q) <= (2025, 1)]

    head = ORIG_HEADER.split(",")
    wide = head + [f"Filler {i}" for i in range(16 - len(head))]
    foot = "\n\nSource: x\nWebsite: y\nEmail: z\n"
    orig = write(tmp + "/o.csv", ",".join(wide) + "\n" + "\n".join(
        f"{q},${50 + i}.25,{10 + i}.5" + ",1" * (len(wide) - 3) for i, q in enumerate(quarters())) + foot)
    bal_head = BAL_HEADER.split(",") + [f'"Filler {i}"' for i in range(36 - len(BAL_HEADER.split(",")))]
    bal = write(tmp + "/b.csv", ",".join(bal_head) + "\n" + "\n".join(
        f'"{q}","${600 + i}.10"' + ',"null"' * (len(bal_head) - 2) for i, q in enumerate(quarters())) + foot)
    res = pipeline.run(spark, pipeline.Sources(originations=orig, balances=bal), tmp + "/wh")
    assert dict((r.source, r.rows) for r in res.reports["sources"].collect())["orig_rows"] == 54
    cov = res.reports["coverage"].first()
    assert (cov.min_quarter_key, cov.max_quarter_key, cov.rows_after_merge) == (20123, 20251, 51)
    fact = Warehouse(spark, tmp + "/wh").read("fact_credit_metrics_qtr").selectExpr("sum(originations_cnt) c", "sum(origination_amt) o", "sum(balance_amt) b").first()
    n = sum(range(51))
    assert (fact.c, fact.o, fact.b) == (51 * 10_500_000 + n * 1_000_000, Decimal(51 * 50.25 + n) * 10**9, Decimal("600.10") * 51 * 10**9 + n * 10**9)
