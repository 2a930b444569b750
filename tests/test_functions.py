import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import money, quarter, text


def _one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_money_edge_table(spark):
    inputs = ["$2,070.51", "9.37 %", " $5 ", "-3", "$-4", "1e3", "null", "None", "", ".", "NULL",
              "(1.2)", "1_000", "0x10", "nan", "inf", "1d", "1f", None]
    want = [2070.51, 9.37, 5.0, -3.0, -4.0, 1000.0] + [None] * 13
    assert _one_col(spark, inputs, money.to_float) == want


def test_units(spark):
    assert _one_col(spark, ["$55.00"], money.billions_to_amount) == [55e9]
    assert _one_col(spark, ["14.22"], money.millions_to_count) == [14220000]
    # a bare cast truncates; the count is rounded first
    assert _one_col(spark, ["14.2200005"], money.millions_to_count) == [14220001]


def test_quarter_tokens(spark):
    ok = ["2012Q3", "2012 Q3", " 2012q3 ", "Q3 2012", "q3  2012", "\ufeff2012Q3", "Q32012"]
    assert _one_col(spark, ok, quarter.normalize_quarter) == ["2012Q3"] * len(ok)
    bad = ["2012Q5", "2012-Q3", "Source: x", "", None, "12Q3"]
    assert _one_col(spark, bad, quarter.normalize_quarter) == [None] * len(bad)


def test_parse_quarter_columns(spark):
    df = spark.createDataFrame([("2012Q3",), ("2024Q1",), ("junk",)], "YRQTR string")
    out = quarter.add_year_quarter(df).orderBy("quarter_key").collect()
    assert [(r.year, r.quarter_num, r.quarter_start, r.quarter_end, r.quarter_key) for r in out] == [
        (2012, 3, dt.date(2012, 7, 1), dt.date(2012, 9, 30), 20123),
        (2024, 1, dt.date(2024, 1, 1), dt.date(2024, 3, 31), 20241),
    ]
    assert out[0].quarter == "2012Q3"  # raw text kept


def test_missing_quarter_column_raises(spark):
    import pytest

    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(KeyError):
        quarter.add_year_quarter(df)


def test_pct_and_ratio(spark):
    df = spark.createDataFrame([(0, 0), (1, 8), (1, 3), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(money.pct("n", "d")).collect()]
    assert got == [0.0, 12.5, 33.33, 66.67]


def test_text_helpers(spark):
    df = spark.createDataFrame([("", "b", "  x\t"), (None, "", "y")], "a string, b string, c string")
    out = df.select(text.first_non_empty("a", "b").alias("f"), text.strip_blanks("c").alias("s")).collect()
    assert [(r.f, r.s) for r in out] == [("b", "x"), (None, "y")]
    m = spark.createDataFrame([({"Year": "2001.9"},)], "m map<string,string>")
    r = m.select(text.lookup("m", "Year").alias("y"), text.lookup("m", "nope").alias("n"),
                 text.text_to_int_truncating(text.lookup("m", "Year")).alias("i")).first()
    assert (r.y, r.n, r.i) == ("2001.9", None, 2001)


def test_nan_never_passes(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,)], "x double")
    assert [r[0] for r in df.select(money.nan_to_null("x")).collect()] == [None, None, 1.5]


def test_cents_half_up(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (0.07,), (2.5,)], "x double")
    got = [r[0] for r in df.select(money.round_half_up(F.col("x") * 100)).collect()]
    assert got == [13, -13, 7, 250]
