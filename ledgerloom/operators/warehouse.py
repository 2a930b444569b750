"""Star-schema warehouse on Parquet.

Tables live under one root folder (``<root>/<table>``); the fact is
partitioned by ``quarter_key``.  Upserts are idempotent:

* dimension upsert (W3): SCD type 1, all non-key columns overwritten;
* fact upsert (W4): all six measures overwritten, NULL included, and only
  the ``quarter_key`` partitions the incoming rows touch are rewritten
  (dynamic partition overwrite);
* recreate (W5): the fact is replaced by the incoming rows.

Before a fact write, rows without a key, with a key its dimension lacks, or
superseded within their batch are set apart as rejects (W9, J9).

No table is overwritten: a load writes new folders and publishes them all
with one version file (:mod:`.snapshots`).  A load that dies before that
leaves every table as it was, and its rerun starts from there.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..session import ensure_checkpoint_dir
from .keys import get_or_create
from .quality import dq_capture, keep_first, last_per_key, union_rejects
from .scale import shuffle_partitions
from .snapshots import Live, Snapshots


def merge_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``incoming``, plus all of
    ``incoming`` (the incoming row wins, NULL measures included)."""
    keys = list(keys)
    kept = existing.join(incoming.select(*keys), keys, "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def touched_quarters(incoming: DataFrame) -> DataFrame:
    """Distinct quarter keys of an incoming batch."""
    return incoming.select("quarter_key").distinct()


def fact_partition_merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """W4 on the touched partitions only: existing rows of the incoming
    quarters, merged with the incoming rows.  With a partitioned table scan
    the semi join prunes the untouched partitions (dynamic pruning)."""
    hit = existing.join(touched_quarters(incoming), "quarter_key", "left_semi")
    return merge_upsert(hit, incoming, C.FACT_KEY)


def fact_upsert_frame(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """W4 as a frame: the whole fact after the upsert."""
    untouched = existing.join(touched_quarters(incoming), "quarter_key", "left_anti")
    return untouched.unionByName(fact_partition_merge(existing, incoming))


def align_to_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract columns in order; missing ones are added as
    typed NULL, extra legacy columns are kept after them and made nullable."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [F.when(F.col(c).isNotNull(), F.col(c)).alias(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (NULLs group together)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def not_null_violations(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """NULL count per NOT NULL column, one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot([], list(cols), "column_name", "null_rows").select(
        F.lit(table).alias("table_name"), "column_name", "null_rows")


def fk_orphans(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (a NULL key is a
    NOT NULL violation, reported by :func:`not_null_violations`)."""
    dim_key = dim_key or fk
    d = dim.select(F.col(dim_key).alias("_dk")).distinct()
    f = fact.where(F.col(fk).isNotNull())
    return f.join(d, f[fk] == d["_dk"], "left_anti")


def load_checks(rows: DataFrame, dims: dict[str, DataFrame], load_order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """W9 + J9 before a fact write: ``(rows to load, rejects)``.

    Rejected as ``null_<key>``: rows without a key; as ``<key>_orphan``: rows
    whose key its dimension lacks; as ``fact_superseded``: all but the last
    row of a fact key in ``load_order`` (without a load order, rows of one
    key must not differ in number: the caller checks).
    """
    rejects, good = [], rows
    for key in C.FACT_KEY:
        rejects.append(dq_capture(good, F.col(key).isNull(), f"null_{key}", C.FACT_KEY))
        good = good.where(F.col(key).isNotNull())
    for key, (table, dim_key) in C.FACT_FOREIGN_KEYS.items():
        known = dims[table].select(F.col(dim_key).alias("_dk")).distinct()
        rejects.append(fk_orphans(good, dims[table], key, dim_key).select(*C.FACT_KEY, F.lit(f"{key}_orphan").alias("dq_reason")))
        good = good.join(known, good[key] == known["_dk"], "left_semi")
    if load_order:
        good, late = last_per_key(good, C.FACT_KEY, load_order, "fact_superseded")
        rejects.append(late.select(*C.FACT_KEY, "dq_reason"))
    return good, union_rejects(*rejects)


class Warehouse:
    """A folder of Parquet tables that follows the star-schema contract.

    Each writing method publishes on its own; inside ``with wh.load():`` they
    read what the load wrote so far, and everything is published at its end,
    or nothing if it fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.snapshots = Snapshots(spark, root)
        self._open: dict[str, Live] | None = None
        self._after = 0

    @contextmanager
    def load(self) -> Iterator[Warehouse]:
        """One load: all of its tables are switched at once."""
        if self._open is not None:  # part of the load around it
            yield self
            return
        self._after = self.snapshots.number()
        found = self.snapshots.tables(self._after)
        self._open = {t: dict(live) for t, live in found.items()}
        try:
            yield self
            if self._open != found:
                self.snapshots.publish(self._after, self._open)
        finally:
            self._open = None

    def _live(self, table: str) -> Live | None:
        return (self.snapshots.tables() if self._open is None else self._open).get(table)

    def path(self, table: str) -> str:
        """Where a table's generations lie."""
        return os.path.join(self.root, table)

    def exists(self, table: str) -> bool:
        return self._live(table) is not None or self.snapshots.exists(table)

    def read(self, table: str) -> DataFrame:
        """Read a table against its contract (missing columns → NULL).
        A table that no version names is read from its plain folder."""
        schema = C.TABLE_SCHEMAS[table]
        live = self._live(table)
        reader, names = self.spark.read.schema(schema), schema.fieldNames()
        if live is None and self.snapshots.exists(table):
            return reader.parquet(self.path(table)).select(*names)
        # The contract schema, not inference: columns missing from older
        # files read as NULL.
        out = None
        for base, paths in self.snapshots.paths(live or {}).items():
            one = reader.option("basePath", base).parquet(*paths).select(*names)
            out = one if out is None else out.unionByName(one)
        return self.spark.createDataFrame([], schema) if out is None else out

    def create_tables_if_missing(self) -> None:
        """An empty, typed table for every contract table not present."""
        with self.load():
            for name, schema in C.TABLE_SCHEMAS.items():
                if not self.exists(name):
                    self._write(self.spark.createDataFrame([], schema), name, static=True)

    def _write(self, df: DataFrame, table: str, static: bool = False) -> None:
        """Write the rows to a new generation, which replaces the table
        (``static``) or the partitions it holds.  Rows may be read from the
        table itself: its files stay."""
        generation = self.snapshots.new_generation(table)
        where = os.path.join(self.root, generation)
        with self.load():
            if table in C.PARTITIONED_BY:
                df.write.partitionBy(C.PARTITIONED_BY[table]).parquet(where)
                live = {part: generation for part in self.snapshots.partitions(generation)}
                self._open[table] = live if static else (self._open.get(table) or self._legacy(table)) | live
            else:
                df.write.parquet(where)
                self._open[table] = {"": generation}

    def _legacy(self, table: str) -> Live:
        """The partitions of a plain folder that no version names yet."""
        return {part: table for part in self.snapshots.partitions(table)}

    def _materialize(self, df: DataFrame) -> DataFrame:
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    def upsert_dim_date(self, rows: DataFrame) -> None:
        """Upsert on quarter_key; duplicates in ``rows`` keep the first."""
        rows = keep_first(rows.select(*C.DIM_DATE_QTR.fieldNames()), ["quarter_key"],
                          ["year", "quarter", "quarter_start", "quarter_end"])
        merged = self._materialize(merge_upsert(self.read("dim_date_qtr"), rows, ["quarter_key"]).coalesce(1))
        self._check_unique("dim_date_qtr", merged)
        self._write(merged, "dim_date_qtr", static=True)

    def _check_unique(self, table: str, rows: DataFrame) -> None:
        """Refuse a dimension in which a PRIMARY or UNIQUE key repeats or
        a NOT NULL column is empty."""
        for key in [C.TABLE_KEYS[table], *C.TABLE_UNIQUE[table]]:
            twice = pk_violations(rows, key).head(1)
            if twice:
                raise ValueError(f"{table}: {key} repeats, e.g. {twice[0].asDict()}")
        needed = [f.name for f in C.TABLE_SCHEMAS[table].fields if not f.nullable]
        empty = not_null_violations(rows, needed, table).where("null_rows > 0").head(1)
        if empty:
            raise ValueError(f"{table}: {empty[0].column_name} is NULL in {empty[0].null_rows} rows")

    def get_or_create(self, table: str, incoming: DataFrame) -> DataFrame:
        """Add missing members, return the whole dimension."""
        natural = C.GEO_NATURAL_KEY if table == "dim_geo" else C.PRODUCT_NATURAL_KEY
        key = C.TABLE_KEYS[table][0]
        dim, new = get_or_create(self.read(table), incoming, natural, key)
        new = self._materialize(new)
        if not new.isEmpty():
            self._write(self.read(table).unionByName(new.select(*C.TABLE_SCHEMAS[table].fieldNames())), table, static=True)
        return self.read(table)

    def _loadable(self, rows: DataFrame, load_order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """The rows that pass the load checks, materialised, and the rejects."""
        dims = {t: self.read(t) for t, _ in C.FACT_FOREIGN_KEYS.values()}
        rows = self._materialize(rows.select(*C.FACT_CREDIT_METRICS_QTR.fieldNames(), *load_order))
        if not load_order:
            twice = pk_violations(rows, C.FACT_KEY).head(1)
            if twice:
                raise ValueError(f"fact rows share a key and need a load order, e.g. {twice[0].asDict()}")
        good, rejects = load_checks(rows, dims, load_order)
        return self._materialize(good.select(*C.FACT_CREDIT_METRICS_QTR.fieldNames())), self._materialize(rejects)

    def upsert_fact(self, rows: DataFrame, load_order: Sequence[str] = ()) -> DataFrame:
        """Overwrite the measures of matching keys, insert the rest; only
        touched quarter partitions are rewritten.  Of rows that share a key
        the last in ``load_order`` wins.  Returns the rejected rows."""
        good, rejects = self._loadable(rows, load_order)
        # Only the touched partitions get a new generation.
        out = fact_partition_merge(self.read("fact_credit_metrics_qtr"), good)
        out = out.repartitionByRange(shuffle_partitions(self.spark), *C.FACT_KEY)
        self._write(out, "fact_credit_metrics_qtr")
        return rejects

    def recreate_fact(self, rows: DataFrame, load_order: Sequence[str] = ()) -> DataFrame:
        """The fact becomes exactly the loadable ``rows``; returns the
        rejected ones."""
        good, rejects = self._loadable(rows, load_order)
        out = good.repartitionByRange(shuffle_partitions(self.spark), *C.FACT_KEY)
        self._write(out, "fact_credit_metrics_qtr", static=True)
        return rejects

    def counts(self) -> DataFrame:
        """Row count of every table as (table_name, cnt)."""
        return table_counts({t: self.read(t) for t in C.TABLE_SCHEMAS})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A5: ``(table_name, cnt)`` for each named frame, one union of counts."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------ catalog
def _ddl_type(t: T.DataType) -> str:
    return t.simpleString()


def schema_diff(actual: T.StructType, contract: T.StructType) -> list[tuple[str, str]]:
    """``(column, finding)`` for every difference from the contract:
    ``missing``, ``extra``, ``type <actual> != <contract>`` or
    ``not null`` (a legacy NOT NULL the contract does not require)."""
    out = []
    have = {f.name: f for f in actual.fields}
    for f in contract.fields:
        if f.name not in have:
            out.append((f.name, "missing"))
        elif have[f.name].dataType != f.dataType:
            out.append((f.name, f"type {_ddl_type(have[f.name].dataType)} != {_ddl_type(f.dataType)}"))
    for name, f in have.items():
        if name not in contract.fieldNames():
            out.append((name, "extra"))
            if not f.nullable:
                out.append((name, "not null"))
    return out


def register_tables(spark: SparkSession, root: str, database: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` over the published
    folders (the fact ``PARTITIONED BY (quarter_key)``, each partition at its
    own location), so the star can be queried with plain SQL.  Tables that are
    there already are switched to the published version: ``ALTER TABLE … SET
    LOCATION``, and for the fact only the partitions that moved.  Returns the
    qualified table names."""
    names, wh = [], Warehouse(spark, root)
    found = wh.snapshots.tables()
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in C.TABLE_SCHEMAS.items():
        cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in schema.fields)
        key = C.PARTITIONED_BY.get(name)
        part = f" PARTITIONED BY ({key})" if key else ""
        qn = f"`{database}`.`{name}`" if database else f"`{name}`"
        live = found.get(name)
        place = os.path.join(root, live[""]) if live and not key else wh.path(name)
        known = spark.catalog.tableExists(qn)
        if not known:
            spark.sql(f"CREATE TABLE {qn} ({cols}) USING parquet{part} LOCATION '{place}'")
        elif not key:
            spark.sql(f"ALTER TABLE {qn} SET LOCATION '{place}'")
        if key and live is None:
            # A plain folder: pick up the partitions on disk.
            spark.sql(f"MSCK REPAIR TABLE {qn}")
        elif key:
            _switch_partitions(spark, qn, {p: os.path.join(root, g, p) for p, g in live.items()})
        spark.catalog.refreshTable(qn)
        names.append(qn)
    return names


def _switch_partitions(spark: SparkSession, table: str, wanted: dict[str, str]) -> None:
    """Make a catalog table's partitions those of ``wanted`` (folder name →
    location); a SET LOCATION to the same folder changes nothing."""
    have = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    for part in have:
        spec = "=".join(f"'{x}'" if k else f"`{x}`" for k, x in enumerate(part.split("=", 1)))
        if part not in wanted:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        else:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{wanted[part]}'")
    new = [p for p in sorted(wanted) if p not in set(have)]
    for at in range(0, len(new), 100):
        specs = " ".join("PARTITION (`{}`='{}') LOCATION '{}'".format(*p.split("=", 1), wanted[p]) for p in new[at:at + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def heal_table(spark: SparkSession, table: str, contract: T.StructType) -> list[tuple[str, str]]:
    """W8 on a catalog table: add the contract columns it lacks (``ALTER
    TABLE … ADD COLUMNS``); returns what was found before healing.  Legacy
    NOT NULL columns are read as nullable by Spark's Parquet reader, and key
    uniqueness is checked with :func:`pk_violations`."""
    actual = spark.table(table).schema
    found = schema_diff(actual, contract)
    missing = [f for f in contract.fields if f.name not in actual.fieldNames()]
    if missing:
        cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return found
