from pyspark.sql import functions as F
from ledgerloom.sources import csv_files, records, series
from conftest import rows
from fixtures import bal_csv, lending_xml, orig_csv, series_csv

Q = [("2012Q3", "55.00", "14.22"), ("2012Q4", "63.94", "17.45"), ("2013Q1", "1,001.50", "8.62")]


def test_csv_rows_footers_and_values(spark, tmp):
    p = orig_csv(tmp + "/o.csv", Q)
    raw = csv_files.read_fed_csv(spark, p)
    assert raw.count() == 6  # 3 data rows + 3 one-field footers; blank line skipped
    o = csv_files.extract_origination(spark, p)
    got = rows(o.where("quarter like '20%'"), "quarter", "origination_amt", "originations_cnt")
    assert [r._line for r in o.orderBy("_line").collect()][:3] == sorted(r._line for r in o.collect())[:3]
    assert got == [("2012Q3", 55e9, 14220000), ("2012Q4", 63.94e9, 17450000), ("2013Q1", 1001.5e9, 8620000)]


def test_csv_preamble_and_bom(spark, tmp):
    for pre, bom in ((True, False), (False, True), (True, True)):
        p = orig_csv(f"{tmp}/p{pre}{bom}.csv", Q, preamble=pre, bom=bom)
        o = csv_files.extract_origination(spark, p)
        assert o.count() == 6
        assert {r.quarter for r in o.collect()} >= {"2012Q3", "2013Q1"}


def test_quoted_balances_and_absent(spark, tmp):
    p = bal_csv(tmp + "/b.csv", [("2012Q3", "578.17"), ("2012Q4", "3,002.42")])
    b = csv_files.extract_balances(spark, p)
    assert rows(b.where("balance_amt is not null"), "quarter", "balance_amt") == [
        ("2012Q3", 578.17e9), ("2012Q4", 3002.42e9)]
    assert csv_files.extract_balances(spark, tmp + "/missing.csv") is None


def test_xml_records_last_wins_and_broken_file_dropped(spark, tmp):
    good = [
        [("Country or Area", "United States"), ("Year", "2001"), ("Value", "6.91")],
        [("Country or Area", ""), ("Country", "United States"), ("Year", "2002.0"), ("Value", "1"), ("Value", "4.68")],
        [("Country or Area", "United States"), ("Year", "2003"), ("Value", None)],
        [("Country or Area", "Canada"), ("Year", "2001"), ("Value", "5.8")],
        [("Country or Area", "United States"), ("date", "2004"), ("value", " 4.34 ")],
    ]
    lending_xml(tmp + "/x/good.xml", good)
    lending_xml(tmp + "/x/bad.xml", [[("Country or Area", "United States"), ("Year", "1999"), ("Value", "9")]] * 40,
                broken=True)
    recs = records.read_xml_records(spark, tmp + "/x")
    got = rows(records.lending_yearly(recs, "United States"))
    assert got == [(2001, 6.91), (2002, 4.68), (2004, 4.34)]
    assert records.read_xml_records(spark, tmp + "/nope") is None


def test_series_discovery(spark, tmp):
    p = series_csv(tmp + "/s.csv", [("2012-07-02", "3.25"), ("2012-07-03", "."), ("bad", "3.0"), ("2012-10-01", "3.5")])
    s = series.read_series(spark, p, series_id="PRIME")
    import datetime as dt
    assert sorted(rows(s, "date", "value")) == [(dt.date(2012, 7, 2), 3.25), (dt.date(2012, 10, 1), 3.5)]
    df = spark.createDataFrame([("x", "2012-01-05", "7"), ("y", "nodate", "8")], "Label string, When string, Amount string")
    out = series.series_from_frame(df)
    assert rows(out, "value") == [(7.0,)]
    assert series.read_series(spark, tmp + "/none.csv").count() == 0


def test_too_long_rows_flagged(spark, tmp):
    from fixtures import write, ORIG_HEADER
    p = write(tmp + "/long.csv", ORIG_HEADER + "\n2012Q3,$1,2,3,4,5,6\n2012Q4,$1,2,3,4\n")
    df = csv_files.read_csv_map(spark, p, {"YRQTR": "quarter", "Average Original Purchase APR: General Purpose": "apr"})
    df = df.cache()
    assert rows(csv_files.too_long_rows(df, "apr")) == [("2012Q3", "row_too_long")]


def test_series_discovery_one_pass(spark):
    # No column named date: the first column holding any date wins even if
    # its first rows do not parse; the value is the first other numeric
    # column (a text column before it is skipped).  One Spark job decides.
    import datetime as dt
    df = spark.createDataFrame(
        [("n/a", "a", "x", "1.5"), ("2020-01-02", "b", "y", "2.5"), ("2020-01-03", "c", "z", None)],
        "Period string, Note string, Tag string, Level string")
    sc = spark.sparkContext

    def jobs(frame, group):
        sc.setJobGroup(group, group)
        out = series.series_from_frame(frame)
        sc.setJobGroup("other", "other")
        return out, len(sc.statusTracker().getJobIdsForGroup(group))

    out, narrow = jobs(df, "series-narrow")
    assert rows(out, "date", "value") == [(dt.date(2020, 1, 2), 2.5)]
    # Eight more text columns ahead of the value: still the same jobs.
    wide = df.select("Period", *[F.lit("t").alias(f"pad{i}") for i in range(8)], "Note", "Tag", "Level")
    out, wider = jobs(wide, "series-wide")
    assert rows(out, "date", "value") == [(dt.date(2020, 1, 2), 2.5)]
    assert wider == narrow <= 2
    empty = spark.createDataFrame([], "a string, b string")
    assert series.series_from_frame(empty).count() == 0


def test_headers_of_a_folder_are_read_by_executors(spark, tmp, monkeypatch):
    """Three layouts, a blank and an empty file; each line by its own header."""
    from fixtures import write

    write(tmp + "/in/a +b%1.csv", "YRQTR,New Originations ($Billions),Number of New Accounts (Millions)\n2012Q3,$1.00,2\n2012Q4,$3.00\n")
    write(tmp + "/in/b.csv", "\ufeffSource: x\n\nNumber of New Accounts (Millions),QUARTER,New Originations ($Billions)\n4,2013Q1,$5.00\n6,2013Q2,$7.00,8\nSource: x\n")
    write(tmp + "/in/c.csv", "Note,YRQTR,New Originations ($Billions),Number of New Accounts (Millions)\n\"a, \"\"b\"\"\",2013Q3,\"$1,000.00\",9\n")
    write(tmp + "/in/d.csv", "\n  \n")
    write(tmp + "/in/e.csv", "")
    write(tmp + "/in/_hidden.csv", "x\n")
    files = csv_files.data_files(spark, tmp + "/in")
    assert [f.rsplit("/", 1)[1] for f in files] == ["a +b%1.csv", "b.csv", "c.csv", "d.csv"]
    heads = {r.name: (r.preamble, r.header) for r in csv_files.file_heads(spark, files).collect()}
    assert heads["b.csv"] == ("Source: x", "Number of New Accounts (Millions),QUARTER,New Originations ($Billions)")
    assert heads["a +b%1.csv"][0] is None and set(heads) == {"a +b%1.csv", "b.csv", "c.csv"}
    for broadcast in (10_000, 0):
        monkeypatch.setattr(csv_files, "BROADCAST_FILES", broadcast)
        kept, long = csv_files.split_too_long(csv_files.extract_origination(spark, tmp + "/in"))
        got = rows(kept.where("origination_amt IS NOT NULL"), "quarter", "origination_amt", "originations_cnt")
        assert got == [("2012Q3", 1e9, 2000000), ("2012Q4", 3e9, None), ("2013Q1", 5e9, 4000000), ("2013Q3", 1000e9, 9000000)]
        assert rows(long) == [("2013Q2", "row_too_long")]
    blank = write(tmp + "/blank.csv", "\n \n")
    assert csv_files.read_fed_csv(spark, blank) is None


def test_a_misnested_file_is_dropped_and_parsed_once(spark, tmp):
    from fixtures import write

    lending_xml(tmp + "/x/good.xml", [[("Country", "A"), ("Year", "2001"), ("Value", "1")]] * 3)
    write(tmp + "/x/bad.xml", '<Root><record><field name="Country">A</field></record><record><field name="Year">2001</record></field></Root>')
    assert rows(records.lending_yearly(records.read_xml_records(spark, tmp + "/x"), "A")) == [(2001, 1.0)] * 3


def test_exports_of_a_folder_choose_their_own_columns(spark, tmp):
    import datetime as dt

    from fixtures import write

    d = dt.date
    write(tmp + "/s/a.csv", "DATE,x,Rate\n2020-01-01,t,1.5\n2020-01-02,,.\n")
    # The note holds a number in its last line only: it is the value column.
    write(tmp + "/s/b.csv", "Note,When,Level\n" + "n,no,7\n" * 5 + "n,2020-02-01,8\n9,2020-02-02,10\n")
    write(tmp + "/s/c.csv", "Level,Note\n1,none\n2,of these is a date\n")
    write(tmp + "/s/d.csv", "Source: y\nLevel,observation_date\n\"1,000\",2020-03-01\n5,03/02/2020\n")
    for n in (1, 3, 50):
        got = series.read_series_folder(spark, tmp + "/s", first_lines=n)
        assert rows(got) == sorted([("a.csv", d(2020, 1, 1), 1.5), ("b.csv", d(2020, 2, 2), 9.0), ("d.csv", d(2020, 3, 2), 5.0)])
    assert rows(series.read_series(spark, tmp + "/s", series_id="P"), "series_id", "value") == [("P", 1.5), ("P", 5.0), ("P", 9.0)]
    assert series.read_series_folder(spark, tmp + "/none").count() == 0
