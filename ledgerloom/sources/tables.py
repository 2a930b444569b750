"""Parquet tables read by path, with their schema resolved once.

Inferring a Parquet schema runs a small Spark job that reads a footer.  A
catalogued table has its schema on record; for tables addressed by path
the schema is kept here, keyed by the path and its modification time (one
driver-side status call, no listing), so a rewritten table is inferred
again and an unchanged one is read with its known schema.  A path whose
status carries no modification time is inferred on every read.
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Least recently used schemas are dropped beyond this many paths, so a
# long-lived driver reading many tables keeps a bounded cache.
MAX_SCHEMAS = 1024
_SCHEMAS: OrderedDict[tuple, StructType] = OrderedDict()


def _signature(spark: SparkSession, path: str) -> tuple | None:
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        st = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
        mtime = int(st.getModificationTime())
        return (path, bool(st.isFile()), int(st.getLen()), mtime) if mtime > 0 else None
    except Exception:
        # Spark Connect or a missing path: no signature, infer every time.
        return None


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    sig = _signature(spark, path)
    schema = _SCHEMAS.get(sig) if sig is not None else None
    if schema is not None:
        _SCHEMAS.move_to_end(sig)
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    if sig is not None:
        _SCHEMAS[sig] = df.schema
        while len(_SCHEMAS) > MAX_SCHEMAS:
            _SCHEMAS.popitem(last=False)
    return df
