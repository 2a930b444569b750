from ledgerloom import contracts as C
from ledgerloom.operators import keys
from conftest import rows

NAT = C.GEO_NATURAL_KEY


def _geo(spark, data):
    return spark.createDataFrame(data, "country string, state_province string, city string")


def test_get_or_create_null_safe(spark):
    dim = spark.createDataFrame([(1, "US", None, None), (2, "CA", "ON", None), (3, "US", None, None)], C.DIM_GEO)
    inc = _geo(spark, [("US", None, None), ("MX", None, None), ("CA", "ON", None), (None, None, None), ("MX", None, None)])
    after, new = keys.get_or_create(dim, inc, NAT, "geo_key")
    assert rows(new) == [(4, None, None, None), (5, "MX", None, None)]
    assert after.count() == 5
    # rerun: nothing new (idempotent)
    again, new2 = keys.get_or_create(after, inc, NAT, "geo_key")
    assert new2.count() == 0 and again.count() == 5
    # stamping picks the first key of a duplicated natural key
    stamped = keys.stamp_keys(inc.where("country = 'US'"), after, NAT, "geo_key")
    assert [r.geo_key for r in stamped.collect()] == [1]


def test_segmented_numbering_is_dense_and_ordered(spark):
    df = spark.range(5000).selectExpr("if(id % 37 = 5, null, cast(id % 37 as string)) as a", "cast(id as string) as b")
    seg = keys.number_rows(df, ["a", "b"], "k")
    data = sorted(((r.a, r.b) for r in df.collect()), key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    want = sorted(((a, b, k + 1) for k, (a, b) in enumerate(data)), key=repr)
    assert rows(seg, "a", "b", "k") == want
    assert keys.number_rows(df.limit(0), ["a", "b"], "k").count() == 0


def test_load_order_equals_two_loads(spark):
    early = _geo(spark, [("B", None, None), ("A", "x", None)])
    late = _geo(spark, [("A", None, None), ("B", None, None), ("C", "y", None), ("A", "x", None)])
    empty = spark.createDataFrame([], C.DIM_GEO)
    first, _ = keys.get_or_create(empty, early, NAT, "geo_key")
    two, _ = keys.get_or_create(first, late, NAT, "geo_key")
    from pyspark.sql import functions as F
    loads = early.withColumn("l", F.lit(0)).unionByName(late.withColumn("l", F.lit(1)))
    assert rows(keys.keys_in_load_order(loads, "l", NAT, "geo_key")) == rows(two)
