from pyspark.sql import functions as F

from ledgerloom.operators import enrich
from conftest import rows


def _fanout(spark, n_left, dup_keys):
    left = spark.range(n_left).select(F.col("id").alias("k"))
    right = spark.range(n_left).select(F.col("id").alias("k"))
    if dup_keys:
        right = right.unionByName(spark.range(dup_keys).select(F.col("id").alias("k")))
    return enrich.fanout_report(left, right, ["k"], "t").first()


def test_fanout_thresholds(spark):
    r = _fanout(spark, 100, 1)
    assert (r.before_rows, int(r.after_rows), r.ratio, r.fanout_warn) == (100, 101, 1.01, False)
    r = _fanout(spark, 100, 2)
    assert (int(r.after_rows), r.fanout_warn) == (102, True)
    r = _fanout(spark, 0, 0)
    assert (r.before_rows, r.ratio, r.fanout_warn) == (0, None, False)


def test_fanout_hot_many_to_many_no_overflow(spark):
    left = spark.range(3_000_000).select(F.lit(1).alias("k"))
    right = spark.range(3_000_000).select(F.lit(1).alias("k"))
    r = enrich.fanout_report(left, right, ["k"], "hot", how="inner").first()
    assert int(r.after_rows) == 9 * 10**12 and r.fanout_warn


def test_enrich_keeps_rows_and_missing_source(spark):
    base = spark.createDataFrame([(2012, 3, 20123), (2012, 4, 20124), (2013, 1, 20131)],
                                 "year int, quarter_num int, quarter_key int")
    dflt = spark.createDataFrame([(2012, 3, 0.02)], "year int, quarter_num int, default_rate double")
    lend = spark.createDataFrame([(2012, 3.25)], "year int, lending_rate double")
    out = enrich.enrich_rates(base, dflt, None, lend)
    assert out.count() == base.count()
    assert rows(out, "quarter_key", "default_rate", "prime_rate", "lending_rate") == [
        (20123, 0.02, None, 3.25), (20124, None, None, 3.25), (20131, None, None, None)]


def test_quarterly_means(spark):
    s = spark.createDataFrame([("2012-07-02", 3.0), ("2012-08-01", 4.0), ("2012-10-01", None), ("2012-10-02", 5.0)],
                              "d string, value double").select(F.to_date("d").alias("date"), "value")
    assert rows(enrich.prime_quarterly(s)) == [(20123, 2012, 3, 3.5), (20124, 2012, 4, 5.0)]
    assert rows(enrich.default_quarterly(s)) == [(2012, 3, 0.035), (2012, 4, 0.05)]


def test_join_balances_normalises_tokens(spark):
    o = spark.createDataFrame([("2012Q3", 1.0), ("Q4 2012", 2.0), ("Source: x", None)], "quarter string, origination_amt double")
    b = spark.createDataFrame([("2012 Q3", 10.0), ("2012Q4", 20.0)], "quarter string, balance_amt double")
    out = enrich.join_balances(o, b)
    assert rows(out, "quarter_key", "balance_amt") == [(20123, 10.0), (20124, 20.0)]
    strict = enrich.join_balances(o, b, strict_raw_key=True)
    assert rows(strict, "quarter_key", "balance_amt") == [(20123, None), (20124, None)]
