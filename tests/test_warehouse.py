import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom import contracts as C
from ledgerloom.operators import warehouse as W
from conftest import rows


def _dims(wh, *quarters):
    """The dimension rows that the facts of these tests refer to."""
    spark = wh.spark
    wh.upsert_dim_date(spark.createDataFrame(
        [(q, q // 10, q % 10, dt.date(q // 10, q % 10 * 3 - 2, 1), dt.date(q // 10, q % 10 * 3, 28)) for q in quarters], C.DIM_DATE_QTR))
    wh.get_or_create("dim_geo", spark.createDataFrame([C.DEFAULT_GEO], "country string, state_province string, city string"))
    wh.get_or_create("dim_product", spark.createDataFrame([C.DEFAULT_PRODUCT], "product_code string, product_type string, segment string"))


def _fact(spark, data):
    return spark.createDataFrame(
        [(q, 1, 1, n, Decimal(a), None, None, None, None) for q, n, a in data], C.FACT_CREDIT_METRICS_QTR)


def test_upsert_idempotent_and_order_free(spark, tmp):
    wh = W.Warehouse(spark, tmp + "/a")
    wh.create_tables_if_missing()
    assert rows(wh.counts()) == [("dim_date_qtr", 0), ("dim_geo", 0), ("dim_product", 0), ("fact_credit_metrics_qtr", 0)]
    _dims(wh, 20123, 20124, 20131)
    batch = _fact(spark, [(20123, 1, "1.00"), (20124, 2, "2.00"), (20131, 3, "3.00")])
    wh.upsert_fact(batch)
    once = rows(wh.read("fact_credit_metrics_qtr"))
    wh.upsert_fact(batch)
    assert rows(wh.read("fact_credit_metrics_qtr")) == once
    # disjoint halves in either order give the whole
    for order in ([0, 1], [1, 0]):
        wh2 = W.Warehouse(spark, f"{tmp}/b{order[0]}")
        _dims(wh2, 20123, 20124, 20131)
        halves = [batch.where("quarter_key < 20131"), batch.where("quarter_key >= 20131")]
        for i in order:
            wh2.upsert_fact(halves[i])
        assert rows(wh2.read("fact_credit_metrics_qtr")) == once


def test_upsert_overwrites_with_null_and_keeps_untouched(spark, tmp):
    wh = W.Warehouse(spark, tmp)
    _dims(wh, 20123, 20124, 20131)
    wh.upsert_fact(_fact(spark, [(20123, 1, "1.00"), (20124, 2, "2.00")]))
    restated = _fact(spark, [(20124, 9, "9.00")]).withColumn("origination_amt", F.lit(None).cast("decimal(18,2)"))
    wh.upsert_fact(restated)
    got = rows(wh.read("fact_credit_metrics_qtr"), "quarter_key", "originations_cnt", "origination_amt")
    assert got == [(20123, 1, Decimal("1.00")), (20124, 9, None)]
    wh.recreate_fact(_fact(spark, [(20131, 5, "5.00")]))
    assert rows(wh.read("fact_credit_metrics_qtr"), "quarter_key") == [(20131,)]


def test_load_checks_set_violators_apart(spark, tmp):
    import pytest

    wh = W.Warehouse(spark, tmp)
    _dims(wh, 20123, 20124)
    twice = _fact(spark, [(20123, 1, "1.00"), (20123, 2, "2.00"), (99999, 3, "3.00"), (20124, 4, "4.00")])
    with pytest.raises(ValueError, match="load order"):
        wh.upsert_fact(twice)
    nulls = twice.withColumn("seq", F.col("originations_cnt")).withColumn(
        "geo_key", F.when(F.col("originations_cnt") != 4, F.col("geo_key")).cast("int"))
    late = wh.upsert_fact(nulls, load_order=["seq"])
    assert rows(late, "quarter_key", "dq_reason") == [
        (20123, "fact_superseded"), (20124, "null_geo_key"), (99999, "quarter_key_orphan")]
    # The last row of a key wins, as row-by-row upserts would leave it.
    assert rows(wh.read("fact_credit_metrics_qtr"), "quarter_key", "originations_cnt") == [(20123, 2)]
    with pytest.raises(ValueError, match="repeats"):
        wh.upsert_dim_date(spark.createDataFrame([(1, 2012, 3, None, None)], "quarter_key int, year int, quarter int, quarter_start date, quarter_end date"))


def test_dim_date_upsert_and_keys(spark, tmp):
    wh = W.Warehouse(spark, tmp)
    d = dt.date
    stale = spark.createDataFrame([(20123, 2012, 3, d(2012, 7, 1), d(2012, 7, 1))], C.DIM_DATE_QTR)
    wh.upsert_dim_date(stale)
    fresh = spark.createDataFrame([(20123, 2012, 3, d(2012, 7, 1), d(2012, 9, 30)),
                                   (20124, 2012, 4, d(2012, 10, 1), d(2012, 12, 31))], C.DIM_DATE_QTR)
    wh.upsert_dim_date(fresh)
    wh.upsert_dim_date(fresh)
    assert rows(wh.read("dim_date_qtr")) == rows(fresh)
    g = wh.get_or_create("dim_geo", spark.createDataFrame([C.DEFAULT_GEO], "country string, state_province string, city string"))
    g = wh.get_or_create("dim_geo", spark.createDataFrame([C.DEFAULT_GEO], "country string, state_province string, city string"))
    assert rows(g) == [(1, "United States", None, None)]


def test_schema_heal_and_contract_checks(spark):
    legacy = spark.createDataFrame([(1, 10), (2, 20)], C.LEGACY_DIM_PRODUCT)
    healed = W.align_to_contract(legacy, C.DIM_PRODUCT)
    assert healed.columns == ["product_key", "product_code", "product_type", "segment", "product_number"]
    assert healed.schema["product_number"].nullable
    f = spark.createDataFrame([(1, 1, None), (1, 1, 2), (2, 3, 4)], "quarter_key int, geo_key int, product_key int")
    assert rows(W.pk_violations(f, ["quarter_key", "geo_key"])) == [(1, 1, 2)]
    assert rows(W.not_null_violations(f, ["quarter_key", "product_key"], "t")) == [
        ("t", "product_key", 1), ("t", "quarter_key", 0)]
    dim = spark.createDataFrame([(1,)], "product_key int")
    assert rows(W.fk_orphans(f, dim, "product_key")) == [(1, 1, 2), (2, 3, 4)]  # NULL key is not an orphan


def test_catalog_register_heal_and_sql_marts(spark, tmp):
    from ledgerloom.plans import marts

    wh = W.Warehouse(spark, tmp + "/wh")
    d = dt.date
    _dims(wh, 20123)
    wh.upsert_fact(_fact(spark, [(20123, 4, "2.50")]))
    db = "mart_" + os.path.basename(tmp).replace("-", "_")
    W.register_tables(spark, tmp + "/wh", db)
    tr = marts.sql_query(spark, marts.TREND_SQL, db).collect()
    assert [(r.year, r.quarter, r.orig_amt_usd) for r in tr] == [(2012, 3, Decimal("2.50"))]
    assert dict((r.table_name, r.cnt) for r in marts.sql_query(spark, marts.COUNTS_SQL, db).collect()) == {
        "dim_date_qtr": 1, "dim_geo": 1, "dim_product": 1, "fact_credit_metrics_qtr": 1}
    yr = marts.sql_query(spark, marts.YEARLY_SQL, db).first()
    assert (yr.year, yr.cnt, yr.amt) == (2012, 4, Decimal("2.50"))
    # legacy product dimension healed in the catalog
    spark.sql(f"CREATE TABLE `{db}`.legacy_product (product_key INT, product_number INT) USING parquet "
              f"LOCATION '{tmp}/legacy'")
    spark.sql(f"INSERT INTO `{db}`.legacy_product VALUES (1, 10)")
    found = W.heal_table(spark, f"`{db}`.legacy_product", C.DIM_PRODUCT)
    assert ("product_code", "missing") in found and ("product_number", "extra") in found
    healed = spark.table(f"`{db}`.legacy_product")
    assert healed.columns == ["product_key", "product_number", "product_code", "product_type", "segment"]
    assert healed.first().product_code is None
    assert W.schema_diff(healed.schema, C.DIM_PRODUCT) == [("product_number", "extra")]
