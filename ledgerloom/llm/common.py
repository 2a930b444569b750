"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

#: Words of a text: runs of anything but space, tab, line feed, vertical
#: tab, form feed and carriage return.  ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast only when its counted rows stay below this.
BROADCAST_ROWS = 100_000

#: Spark's own 10,000 whole documents are some 30 MB, in the executor and again
#: in each Python worker.
ARROW_ROWS, _ARROW_ROWS = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Make the checkpoint folder known and the package importable in
    Python workers (as ``--py-files`` would), once per application; and let
    Arrow batches hold ``ARROW_ROWS`` rows where the session names no number."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(_ARROW_ROWS, None) is None:
        spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        out = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-py-"), "ledgerloom_workers.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(os.path.join(root, "ledgerloom")):
                for n in sorted(names):
                    if n.endswith(".py"):
                        p = os.path.join(folder, n)
                        z.write(p, os.path.relpath(p, root))
        sc.addPyFile(out)
        _SHIPPED.add(sc.applicationId)
    return spark


def hand_out(spark: SparkSession, path: str) -> str:
    """Give every executor a copy of a file of the driver; returns the name
    by which ``here`` finds it in a worker."""
    sc = spark.sparkContext
    if (sc.applicationId, path) not in _SHIPPED:
        sc.addFile(path)
        _SHIPPED.add((sc.applicationId, path))
    return os.path.basename(path)


def here(name: str) -> str:
    """A worker's own copy of a file that ``hand_out`` gave it."""
    from pyspark.files import SparkFiles

    return SparkFiles.get(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage.
    The folder's files go with the frame where the cluster sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def steady(run):
    """A worker function over batches, run without Python's search for
    reference cycles: these functions make millions of lists and no cycles."""

    def wrapped(batches):
        import gc

        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A materialised frame with a broadcast hint if its counted rows are
    few; beyond that the join is left to AQE (sort-merge, skew splitting)."""
    return F.broadcast(df) if df.count() <= max_rows else df


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def range_bounds(df: DataFrame, col: str, parts: int) -> list[int]:
    """Ascending existing values of ``col`` that cut the rows in about
    ``parts`` ranges; at most ``parts - 1`` of them.  They are quantiles of
    about 200 values a range, drawn by hash, so what one task and the driver
    see is bounded by the number of partitions, not by the rows."""
    if parts < 2:
        return []
    few = drawn(df.select(col), col, df.count(), 200 * parts)
    qs = [i / parts for i in range(1, parts)]
    got = few.agg(F.percentile_approx(col, qs, F.lit(20 * parts)).alias("q")).first()["q"]
    return sorted(set(got or []))


def drawn(df: DataFrame, key: str, rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the frame's ``rows`` rows, the same ones on every
    run: those whose key's hash is low.  All rows if there are fewer."""
    if rows <= wanted:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < F.lit(int(wanted / rows * (1 << 40))))


def columns_of(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the named columns, renamed: ``{own name: column of df}``.  Extra
    columns with clashing names never meet the operator's own."""
    return df.select(*[df[c].alias(own) for own, c in wanted.items()])
