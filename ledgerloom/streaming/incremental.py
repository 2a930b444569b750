"""Incremental loading with Structured Streaming.

Fact upserts are idempotent, so they serve as a ``foreachBatch`` body: every micro-batch of new
quarterly fact rows (Parquet files landing in a folder) is upserted into
the warehouse, rewriting only the quarter partitions it touches.  A replayed
batch (after a failure) upserts the same rows again and leaves the same
table, which gives exactly-once results with the checkpointed stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contracts as C
from ..operators.warehouse import Warehouse


#: A stream row's place in arrival order: its file's time and name, then
#: its place in the file.
ARRIVAL = ("_file_time", "_file_name", "_row")


def upsert_batch(warehouse: Warehouse):
    """A ``foreachBatch`` function: upsert the batch; of rows that share a
    fact key the last to arrive wins."""

    def _apply(batch: DataFrame, batch_id: int) -> None:
        warehouse.upsert_fact(batch.withColumn("_row", F.monotonically_increasing_id()), load_order=ARRIVAL)

    return _apply


def start_fact_stream(spark: SparkSession, landing_dir: str, warehouse_root: str, checkpoint: str,
                      once: bool = True) -> StreamingQuery:
    """Stream fact files from ``landing_dir`` into the warehouse fact."""
    wh = Warehouse(spark, warehouse_root)
    wh.create_tables_if_missing()
    stream = spark.readStream.schema(C.FACT_CREDIT_METRICS_QTR).parquet(landing_dir)
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("_file_time"), F.col("_metadata.file_path").alias("_file_name"))
    writer = stream.writeStream.foreachBatch(upsert_batch(wh)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
