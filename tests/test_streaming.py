from decimal import Decimal

from ledgerloom import contracts as C
from ledgerloom.operators.warehouse import Warehouse
from ledgerloom.streaming import start_fact_stream
from conftest import rows


def test_stream_upserts_batches(spark, tmp):
    land = tmp + "/landing"
    a = spark.createDataFrame([(20123, 1, 1, 5, Decimal("1.00"), None, None, None, None)], C.FACT_CREDIT_METRICS_QTR)
    b = spark.createDataFrame([(20123, 1, 1, 7, Decimal("2.00"), None, None, None, None),
                               (20124, 1, 1, 8, Decimal("3.00"), None, None, None, None)], C.FACT_CREDIT_METRICS_QTR)
    from test_warehouse import _dims

    _dims(Warehouse(spark, tmp + "/wh"), 20123, 20124)
    a.write.parquet(land + "/a")
    q = start_fact_stream(spark, land + "/a", tmp + "/wh", tmp + "/ckpt_a")
    q.awaitTermination(120)
    b.write.parquet(land + "/b")
    q = start_fact_stream(spark, land + "/b", tmp + "/wh", tmp + "/ckpt_b")
    q.awaitTermination(120)
    got = rows(Warehouse(spark, tmp + "/wh").read("fact_credit_metrics_qtr"), "quarter_key", "originations_cnt")
    assert got == [(20123, 7), (20124, 8)]


def test_last_row_to_arrive_wins_within_a_batch(spark, tmp):
    from test_warehouse import _dims

    wh = Warehouse(spark, tmp + "/wh")
    _dims(wh, 20123)
    row = (20123, 1, 1, None, None, None, None, None, None)
    spark.createDataFrame([row, (*row[:3], 5, Decimal("9.00"), *row[5:])], C.FACT_CREDIT_METRICS_QTR).coalesce(1).write.parquet(tmp + "/in")
    start_fact_stream(spark, tmp + "/in", tmp + "/wh", tmp + "/ckpt").awaitTermination(120)
    assert rows(wh.read("fact_credit_metrics_qtr"), "originations_cnt", "origination_amt") == [(5, Decimal("9.00"))]
