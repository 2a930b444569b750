"""Spark session settings the library relies on.

`configure(spark)` applies the session-level settings every operator assumes
(UTC clock, last-wins map keys, dynamic partition overwrite, AQE).  It never
touches cluster-level settings that are already present: in particular the
checkpoint folder is read from ``spark.checkpoint.dir`` and only set when the
session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings the operators depend on for their results.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # XML / JSON key-value records: the last duplicate field name wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Upserts rewrite only the partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = _context(spark)
    return sc.getCheckpointDir() if sc is not None else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a scratch one only
    when the session has none (local runs and tests)."""
    d = checkpoint_dir(spark)
    sc = _context(spark)
    if not d:
        master = sc.master if sc is not None else ""
        if not master.startswith("local"):
            # A machine-local folder is invisible to other executors.
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """Session for tests and the local benchmark (no UI, no server ports)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # A test reads the plans of the runs it started; a whole suite starts more than the 1,000 kept.
        .config("spark.sql.ui.retainedExecutions", "10000")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerloom-sql-"))
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
