"""Key/value records.

``<record><field name="Year">2001</field>…</record>`` elements, at any
depth, become one ``map<string,string>`` per record (text trimmed, the last
duplicate name wins via ``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DEFAULT_LENDING_COUNTRY, KV_RECORD_XML
from ..functions.money import parse_number
from ..functions.text import first_non_empty, lookup, text_to_int_truncating
from ..session import scratch_path

CORRUPT = "_corrupt_record"
#: A record's place among the records read.
POSITION = "_position"

# Field names of the lending-rate records and their fallbacks.
COUNTRY_FIELDS = ("Country or Area", "Country")
YEAR_FIELDS = ("Year", "date")
VALUE_FIELDS = ("Value", "value")


def fields_to_map(fields: Column) -> Column:
    """array<struct<_name,_VALUE>> → map name → trimmed text."""
    entries = F.transform(
        fields, lambda f: F.struct(f["_name"].alias("key"), F.regexp_replace(f["_VALUE"], r"^\s+|\s+$", "").alias("value"))
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull()))


def read_xml_records(spark: SparkSession, path: str) -> DataFrame | None:
    """S6 + S8: one row per ``<record>`` with a ``kv`` map.  A file with any
    malformed part is dropped whole (as if absent); ``None`` when the path is
    absent."""
    try:
        raw = (spark.read.format("xml").option("rowTag", "record").option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT)
               .schema(f"{KV_RECORD_XML}, {CORRUPT} string").load(path)
               .withColumn("_file", F.col("_metadata.file_path"))
               .withColumn(POSITION, F.monotonically_increasing_id()))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise
    # The files are parsed once: their records go to the shared folder as maps,
    # with a mark where a file is malformed.  A file's validity is known only
    # when all of it was read; it is then one small aggregate by file over the
    # marks (Parquet statistics skip whole row groups without one).
    staged = scratch_path(spark, f"records-{uuid.uuid4().hex}")
    raw.select("_file", POSITION, F.col(CORRUPT).isNotNull().alias("_bad"), fields_to_map(F.col("field")).alias("kv")).write.parquet(staged)
    parsed = spark.read.schema(f"_file string, {POSITION} bigint, _bad boolean, kv map<string,string>").parquet(staged)
    bad_files = parsed.where("_bad").groupBy("_file").agg(F.count(F.lit(1)).alias("faults"))
    return parsed.join(bad_files, "_file", "left_anti").select(POSITION, "kv")


def lending_yearly(records: DataFrame, country: str = DEFAULT_LENDING_COUNTRY, kv: str = "kv",
                   keep_position: bool = False) -> DataFrame:
    """Records of ``country`` → ``(year, lending_rate)``; records missing
    a year or a value, or holding unparsable ones, are skipped (P6, P7).
    ``keep_position`` adds the record's place, to tell years apart that
    occur twice."""
    m = F.col(kv)
    ctry = first_non_empty(*[lookup(m, k) for k in COUNTRY_FIELDS])
    y_txt = first_non_empty(*[lookup(m, k) for k in YEAR_FIELDS])
    v_txt = first_non_empty(*[lookup(m, k) for k in VALUE_FIELDS])
    out = records.where(ctry == F.lit(country)).select(
        *([POSITION] if keep_position else []),
        text_to_int_truncating(y_txt).alias("year"),
        parse_number(v_txt).alias("lending_rate"),
    )
    return out.where(F.col("year").isNotNull() & F.col("lending_rate").isNotNull())
