"""Catalogue queries of the load's own files: CSV, XML and warehouse folders.

Each writes one of the driver's tables as source files of the kind that the
load reads (names, preambles, footers and faults included), and then runs the
library's readers and writers on that folder.  The writing side only makes
rows of text; whatever a query is named after happens on what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.money import cents
from ..functions.quarter import date_quarter_token
from ..operators import evolve, footers, quality, reports, warehouse
from ..session import scratch_path
from ..sources import csv_files, records, series
from . import oracle as O
from . import star
from .catalog import ORACLE_SQL, T, query


def _files(lines: DataFrame, name: str, files: int) -> str:
    """``file, place, line`` written as ``files`` text files, lines by place."""
    out = scratch_path(lines.sparkSession, f"{name}-{uuid.uuid4().hex}")
    lines.repartitionById(files, "file").sortWithinPartitions("file", "place").select("line").write.text(out)
    return out


def _fixed(spark: SparkSession, files: int, place: int, line: Column) -> DataFrame:
    """The same line (it may depend on ``file``) in every file; NULL: none."""
    return spark.range(files).select(F.col("id").cast("int").alias("file"), F.lit(place).cast("long").alias("place"), line.alias("line")).where("line IS NOT NULL")


# ------------------------------------------------------------ S1, S2, S3
CSV_FILES = 200
_FIRST, _LAST = -10, 1 << 62

# Three layouts of the originations file.
_LAYOUTS = [
    "YRQTR,New Originations ($Billions),Number of New Accounts (Millions),Average Original Purchase APR",
    "Number of New Accounts (Millions),QUARTER,New Originations ($Billions)",
    "﻿YRQTR,Note,New Originations ($Billions),Number of New Accounts (Millions)",
]


def _origination_files(spark: SparkSession, d: str) -> str:
    """Orders as 200 originations files of three header layouts, one of them
    behind a preamble and one with a byte-order mark.  An order whose key is
    divisible by 7 lacks its last cells, one divisible by 11 has two more."""
    o = T(spark, d, "orders")
    key = F.col("o_orderkey")
    file = F.pmod(key, F.lit(CSV_FILES)).cast("int")
    amount = F.concat(F.lit('"$'), F.format_number(cents("o_totalprice") / 100, 2), F.lit('"'))
    count = F.format_string("%d.%02d", F.floor(F.pmod(key, F.lit(9000)) / 100), F.pmod(key, F.lit(100)))
    token = date_quarter_token("o_orderdate")
    short, long = key % 7 == 0, F.when(key % 11 == 0, F.lit(",9,9")).otherwise(F.lit(""))
    line = (F.when(file % 3 == 0, F.when(short, F.concat_ws(",", token, amount)).otherwise(F.concat(F.concat_ws(",", token, amount, count, F.lit("19.34 %")), long)))
            .when(file % 3 == 1, F.when(short, F.concat_ws(",", count, token)).otherwise(F.concat(F.concat_ws(",", count, token, amount), long)))
            .otherwise(F.when(short, F.concat_ws(",", token, F.lit("n"))).otherwise(F.concat(F.concat_ws(",", token, F.lit("n"), amount, count), long))))
    data = o.select(file.alias("file"), key.alias("place"), line.alias("line"))
    layout = F.col("id") % 3
    header = F.when(layout == 0, F.lit(_LAYOUTS[0])).when(layout == 1, F.lit(_LAYOUTS[1])).otherwise(F.lit(_LAYOUTS[2]))
    for extra in (_fixed(spark, CSV_FILES, _FIRST, F.when(layout == 1, F.lit("Source: example survey"))), _fixed(spark, CSV_FILES, _FIRST + 1, header),
                  _fixed(spark, CSV_FILES, -1, F.lit("   ")), _fixed(spark, CSV_FILES, _LAST, F.lit("Source: example survey")), _fixed(spark, CSV_FILES, _LAST + 1, F.lit("Email: data@example.org"))):
        data = data.unionByName(extra)
    return _files(data, "originations", CSV_FILES)


_CSV_SQL = """cells AS (
  SELECT o_orderkey AS k, o_orderkey % 200 % 3 AS layout, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
         (floor(o_totalprice * 100 + 0.5) / 100) * 1000000000.0 AS amt, CAST((o_orderkey % 9000) * 10000 AS BIGINT) AS cnt
  FROM orders)"""


@query("csv_scan", O.with_(_CSV_SQL) + """
SELECT quarter, origination_amt, originations_cnt, dq_reason, COUNT(*) AS n FROM (
  SELECT quarter,
         CASE WHEN k % 7 <> 0 OR layout = 0 THEN amt END AS origination_amt,
         CASE WHEN k % 7 <> 0 OR layout = 1 THEN cnt END AS originations_cnt, NULL AS dq_reason
  FROM cells WHERE k % 7 = 0 OR k % 11 <> 0
  UNION ALL SELECT quarter, NULL, NULL, 'row_too_long' FROM cells WHERE k % 7 <> 0 AND k % 11 = 0)
GROUP BY ALL""")
def csv_scan(spark, d):
    """S1 + S2 + S3: the rows of 200 CSV files of three layouts by their
    contract columns, and the rejected ones; footers hold no quarter."""
    rows, too_long = csv_files.split_too_long(csv_files.extract_origination(spark, _origination_files(spark, d)))
    every = rows.where(F.col("quarter").rlike(r"^\d{4}Q\d$")).select("quarter", "origination_amt", "originations_cnt", F.lit(None).cast("string").alias("dq_reason"))
    every = every.unionByName(too_long, allowMissingColumns=True)
    return every.groupBy(*every.columns).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ S4
BALANCE_FILES = 8
#: More files where one would hold more rows than this.
ROWS_A_FILE = 1_000_000


@query("csv_balances", """
SELECT CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS quarter,
       (floor(l_extendedprice * 100 + 0.5) / 100) * 1000000000.0 AS balance_amt, COUNT(*) AS n
FROM lineitem GROUP BY ALL""")
def csv_balances(spark, d):
    """Line items as quoted balance files, read to dollars."""
    li = T(spark, d, "lineitem")
    quoted = F.concat(F.lit('"'), date_quarter_token("l_shipdate"), F.lit('","$'), F.format_number(cents("l_extendedprice") / 100, 2), F.lit('","null"'))
    files = max(BALANCE_FILES, -(-li.count() // ROWS_A_FILE))
    file = F.pmod(F.col("l_orderkey"), F.lit(files)).cast("int")
    data = li.select(file.alias("file"), F.col("l_orderkey").alias("place"), quoted.alias("line"))
    for place, line in ((_FIRST, '"YRQTR","Total Balances ($Billions)","Number of Accounts (Millions)"'), (_LAST, ""), (_LAST + 1, "Website: https://example.org/data")):
        data = data.unionByName(_fixed(spark, files, place, F.lit(line)))
    rows = csv_files.extract_balances(spark, _files(data, "balances", files)).where("balance_amt IS NOT NULL")
    return rows.groupBy("quarter", "balance_amt").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- S6, S8, S6c
XML_FILES, TRUNCATED, MISNESTED = 40, 7, 8


@query("xml_records", f"""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(floor(value * 100 + 0.5) AS BIGINT) / 100.0::DOUBLE AS lending_rate, COUNT(*) AS n
FROM events WHERE event_type = 'purchase' AND event_id % {XML_FILES} NOT IN ({TRUNCATED}, {MISNESTED}) GROUP BY ALL""")
def xml_records(spark, d):
    """S6 + S8 + S6c: events as 40 XML files of records.  One file ends in
    the middle of a record and one closes its elements in the wrong order:
    both are left out whole."""
    e = T(spark, d, "events")
    file = F.pmod(F.col("event_id"), F.lit(XML_FILES)).cast("int")

    def field(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f'<field name="{name}"> '), F.lit(value) if isinstance(value, str) else value, F.lit("\t</field>"))

    c = cents("value")
    number = F.format_string("%s%d.%02d", F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.floor(F.abs(c) / 100), F.abs(c) % 100)
    record = F.concat(F.lit("<record>"), field("Country or Area", ""), field("Country", F.col("event_type")), field("Year", F.date_format("ts", "yyyy")),
                      field("Value", "n/a"), field("Value", number), F.lit("</record>"))
    data = e.select(file.alias("file"), F.col("event_id").alias("place"), record.alias("line"))
    one = F.col("id")
    for place, line in (
        (_FIRST, F.lit('<?xml version="1.0" encoding="utf-8"?>')), (_FIRST + 1, F.lit("<Root><data>")),
        (_LAST, F.when(one == TRUNCATED, F.lit('<record><field name="Year">2')).when(one == MISNESTED, F.lit('<record><field name="Year">2001</record></field>'))),
        (_LAST + 1, F.when(one != TRUNCATED, F.lit("</data></Root>"))),
    ):
        data = data.unionByName(_fixed(spark, XML_FILES, place, line))
    found = records.read_xml_records(spark, _files(data, "lending", XML_FILES))
    return records.lending_yearly(found, "purchase").groupBy("year", "lending_rate").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ S5
SERIES_FILES, LATE = 30, 1500


@query("series_exports", f"""
SELECT CAST(ts AS DATE) AS date, CAST(floor(value * 100 + 0.5) AS DOUBLE) AS value, COUNT(*) AS n
FROM events
WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND NOT (event_id % {SERIES_FILES} % 3 = 1 AND event_id < {LATE})
GROUP BY ALL""")
def series_exports(spark, d):
    """Events as 30 series exports of three layouts: a named date column;
    one without a name whose first rows hold no date, behind a note; and the
    value before the date.  Unreadable dates and values are dropped."""
    e = T(spark, d, "events")
    file = F.pmod(F.col("event_id"), F.lit(SERIES_FILES)).cast("int")
    layout = file % 3
    date = F.when((F.col("event_id") % 7 == 0) | ((layout == 1) & (F.col("event_id") < LATE)), F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    value = F.when(F.col("event_id") % 11 == 0, F.lit(".")).otherwise(cents("value").cast("string"))
    line = (F.when(layout == 0, F.concat_ws(",", date, F.col("event_type"), value)).when(layout == 1, F.concat_ws(",", F.lit('"a, b"'), date, value))
            .otherwise(F.concat_ws(",", F.col("event_type"), value, date)))
    data = e.select(file.alias("file"), F.col("event_id").alias("place"), line.alias("line"))
    own = F.col("id") % 3
    header = F.when(own == 0, F.lit(" Observation_Date ,Kind,PRIME")).when(own == 1, F.lit("Note,When,Level")).otherwise(F.lit('"Kind","Rate","DATE"'))
    folder = _files(data.unionByName(_fixed(spark, SERIES_FILES, _FIRST, header)), "exports", SERIES_FILES)
    return series.read_series_folder(spark, folder).groupBy("date", "value").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ K1, K2
@query("rejects_file", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, NULL AS l_quantity, 'lines_duplicate_keys' AS dq_reason, COUNT(*) AS n
FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY 1) AS rn FROM lineitem) WHERE rn > 1 GROUP BY ALL
UNION ALL
SELECT NULL, CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 'l_quantity_out_of_range', COUNT(*)
FROM lineitem WHERE l_quantity > 45 GROUP BY ALL""")
def rejects_file(spark, d):
    """K1: the rejects of two gates, whose columns differ, as one CSV folder
    (written over an earlier run's), read back as text."""
    li = T(spark, d, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
    twice = quality.duplicate_key_rejects(li, ["l_orderkey", "l_linenumber"], "lines_duplicate_keys")
    much = quality.range_gate(li, "l_quantity", 0, 45, keep_cols=["l_linenumber", "l_quantity"])[1]
    out = scratch_path(spark, f"rejects-{uuid.uuid4().hex}")
    reports.write_rejects(much, out)  # an earlier run
    reports.write_rejects(quality.union_rejects(twice, much), out)
    names = ["l_orderkey", "l_linenumber", "l_quantity", "dq_reason"]
    back = spark.read.option("header", True).csv(f"{out}/rejects").select(*names)
    return back.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------ K3, K4, R6, F18
@query("report_document", O.with_(O.MEMBERS) + """,
profile AS (UNPIVOT (SELECT """ + ", ".join(f"COUNT({c}) AS {c}" for c in C.MEASURES) + """ FROM members) ON COLUMNS(*) INTO NAME name VALUE non_null),
total AS (SELECT COUNT(*) AS n FROM members)
SELECT 'sources' AS section, 'base_rows' AS name, 'rows' AS field, CAST(n AS DOUBLE) AS value FROM total
UNION ALL SELECT 'sources', 'absent', 'rows', 0.0
UNION ALL (UNPIVOT (SELECT 'coverage' AS section, 'base' AS name, CAST(min(year) AS DOUBLE) AS min_year, CAST(max(year) AS DOUBLE) AS max_year,
    CAST(min(quarter_key) AS DOUBLE) AS min_quarter_key, CAST(max(quarter_key) AS DOUBLE) AS max_quarter_key, CAST(COUNT(*) AS DOUBLE) AS rows_after_merge
    FROM members) ON min_year, max_year, min_quarter_key, max_quarter_key, rows_after_merge INTO NAME field VALUE value)
UNION ALL SELECT 'null_profile', name, 'non_null', CAST(non_null AS DOUBLE) FROM profile
UNION ALL SELECT 'null_profile', name, 'null', CAST(n - non_null AS DOUBLE) FROM profile, total
UNION ALL SELECT 'null_profile', name, 'null_pct', """ + O.half_even("(n - non_null) * 100", "n", 2) + """ FROM profile, total
UNION ALL SELECT 'violations', 'default_rate_out_of_range', 'rows', CAST(COUNT(*) FILTER (WHERE default_rate < 0 OR default_rate > 1) AS DOUBLE) FROM members
UNION ALL SELECT 'violations', 'neg_originations_cnt', 'rows', CAST(COUNT(*) FILTER (WHERE originations_cnt < 0) AS DOUBLE) FROM members
UNION ALL SELECT 'violations', 'neg_origination_amt', 'rows', CAST(COUNT(*) FILTER (WHERE origination_amt < 0) AS DOUBLE) FROM members
UNION ALL SELECT 'violations', 'neg_balance_amt', 'rows', CAST(COUNT(*) FILTER (WHERE balance_amt < 0) AS DOUBLE) FROM members
UNION ALL SELECT 'dupes_on_quarter_key', 'base', 'keys', CAST(COUNT(*) AS DOUBLE) FROM (SELECT quarter_key FROM members GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'generated_at', 'utc', 'stated', 1.0
UNION ALL SELECT 'validation', name, 'null_rate', """ + O.half_up("(n - non_null)", "n", 3) + """ FROM profile, total
UNION ALL SELECT 'validation', 'base', 'rows', CAST(n AS DOUBLE) FROM total
UNION ALL SELECT 'validation', 'base', 'range_bad_default', CAST(COUNT(*) FILTER (WHERE NOT (default_rate BETWEEN 0 AND 1 OR default_rate IS NULL)) AS DOUBLE) FROM members""")
def report_document(spark, d):
    """K3 + K4 + R1-R7: the run report and the validation snapshot of a base
    with faults, each written as one nested JSON document, read back by its
    schema and laid out as rows."""
    base = star.member_base(spark, d).checkpoint(eager=True)
    out = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    reports.write_document(reports.run_document(reports.run_report(base, {"base_rows": base, "absent": None})), f"{out}/run_report")
    reports.write_document(reports.validation_document(base), f"{out}/validation")
    doc = reports.read_document(spark, f"{out}/run_report")
    check = reports.read_document(spark, f"{out}/validation", reports.VALIDATION_DOCUMENT)

    def rows(frame: DataFrame, section: str, values: dict[tuple[str, str], Column]) -> DataFrame:
        one = [F.struct(F.lit(section).alias("section"), F.lit(n).alias("name"), F.lit(f).alias("field"), v.cast("double").alias("value")) for (n, f), v in values.items()]
        return frame.select(F.inline(F.array(*one)))

    def mapped(frame: DataFrame, section: str, column: str, field: str, value) -> DataFrame:
        return frame.select(F.explode(column).alias("name", "v")).select(F.lit(section).alias("section"), "name", F.lit(field).alias("field"), value(F.col("v")).cast("double").alias("value"))

    cover = {("base", f): F.col("coverage")[f] for f in ("min_year", "max_year", "min_quarter_key", "max_quarter_key", "rows_after_merge")}
    stated = F.col("generated_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$")
    parts = [mapped(doc, "sources", "sources", "rows", lambda v: v), rows(doc, "coverage", cover)]
    parts += [mapped(doc, "null_profile", "null_profile", f, lambda v, f=f: v[f]) for f in ("non_null", "null", "null_pct")]
    parts += [mapped(doc, "violations", "violations", "rows", lambda v: v), rows(doc, "dupes_on_quarter_key", {("base", "keys"): F.col("dupes_on_quarter_key")}),
              rows(doc, "generated_at", {("utc", "stated"): stated.cast("int")}), mapped(check, "validation", "null_rates", "null_rate", lambda v: v),
              rows(check, "validation", {("base", "rows"): F.col("rows"), ("base", "range_bad_default"): F.col("range_bad_default")})]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


# ------------------------------------------------------ W1, W12, A5, A9
@query("footer_stats", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM, O.FACT) + """
SELECT 'dim_date_qtr' AS table_name, COUNT(*) AS cnt, CAST(min(year) AS BIGINT) AS first, CAST(max(year) AS BIGINT) AS last FROM date_dim
UNION ALL SELECT 'dim_geo', COUNT(*), CAST(min(geo_key) AS BIGINT), CAST(max(geo_key) AS BIGINT) FROM geo_dim
UNION ALL SELECT 'dim_product', COUNT(*), CAST(min(product_key) AS BIGINT), CAST(max(product_key) AS BIGINT) FROM product_dim
UNION ALL SELECT 'fact_credit_metrics_qtr', COUNT(*), CAST(min(originations_cnt) AS BIGINT), CAST(max(originations_cnt) AS BIGINT) FROM fact""")
def footer_stats(spark, d):
    """W1 + W12 + A9: tables created empty, then loaded; their row counts and
    a column's range, from the Parquet footers alone."""
    wh = warehouse.Warehouse(spark, scratch_path(spark, f"footers-{uuid.uuid4().hex}"))
    with wh.load():
        wh.create_tables_if_missing()
        for name, frame in star.star_tables(spark, d).items():
            wh._write(frame, name, static=True)
    return footers.table_stats(wh, {"dim_date_qtr": "year", "dim_geo": "geo_key", "dim_product": "product_key", "fact_credit_metrics_qtr": "originations_cnt"})


# ------------------------------------------------------------- S10, W8
_GENERATIONS_SQL = """gens AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_key, NULL AS product_code, NULL AS product_type, NULL AS segment, CAST(p_size AS INTEGER) AS product_number, NULL AS lost
  FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey AS INTEGER) END, p_brand, p_type, NULL, NULL,
         CASE WHEN p_partkey % 5 = 0 THEN 'product_key_out_of_contract' END FROM part WHERE p_partkey % 3 = 1
  UNION ALL SELECT CAST(p_partkey AS INTEGER), p_brand, p_type, 'Consumer', NULL, NULL FROM part WHERE p_partkey % 3 = 2),
firsts AS (SELECT product_code, product_type, segment, min(product_key) AS kept FROM gens WHERE product_key IS NOT NULL GROUP BY ALL)"""


@query("schema_generations", O.with_(_GENERATIONS_SQL) + """
SELECT g.product_key, g.product_code, g.product_type, g.segment, g.product_number, CAST(NULL AS INTEGER) AS kept_product_key, CAST(NULL AS VARCHAR) AS dq_reason
FROM gens g JOIN firsts f ON g.product_key = f.kept
UNION ALL SELECT g.product_key, NULL, NULL, NULL, NULL, f.kept, 'uq_prod' FROM gens g JOIN firsts f
  ON g.product_code IS NOT DISTINCT FROM f.product_code AND g.product_type IS NOT DISTINCT FROM f.product_type AND g.segment IS NOT DISTINCT FROM f.segment
WHERE g.product_key <> f.kept
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, lost FROM gens WHERE lost IS NOT NULL""")
def schema_generations(spark, d):
    """S10 + W8: the product dimension in files of three generations (a legacy
    one without its natural key, one with wider keys, some of them beyond the
    contract, and one of the contract), read to the contract, and its unique
    key repaired."""
    p = T(spark, d, "part")
    key, out = F.col("p_partkey"), scratch_path(spark, f"generations-{uuid.uuid4().hex}")
    wide = F.when(key % 5 == 0, key + F.lit(1 << 40)).otherwise(key)
    made = {
        "a": p.where(key % 3 == 0).select(key.cast("int").alias("product_key"), F.col("p_size").cast("smallint").alias("product_number")),
        "b": p.where(key % 3 == 1).select(wide.alias("product_key"), F.col("p_brand").alias("product_code"), F.col("p_type").alias("product_type")),
        "c": p.where(key % 3 == 2).select(key.cast("int").alias("product_key"), F.col("p_brand").alias("product_code"), F.col("p_type").alias("product_type"), F.lit("Consumer").alias("segment")),
    }
    for name, frame in made.items():
        frame.write.parquet(f"{out}/{name}")
    rows, lost = evolve.read_generations(spark, [f"{out}/{n}" for n in made], C.DIM_PRODUCT, ["product_key"])
    kept, losers = evolve.repair_unique(rows.where("product_key IS NOT NULL"), C.PRODUCT_NATURAL_KEY, "product_key", "uq_prod")
    kept = kept.withColumn("product_number", F.col("product_number").cast("int"))
    return kept.unionByName(losers, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)


# ------------------------------------------- the whole load, K5, K6, W1-W7
def _one_file(spark: SparkSession, name: str, header: str, rows: DataFrame) -> str:
    """``place, line`` behind a header, as one file."""
    data = rows.select(F.lit(0).alias("file"), F.col("place").cast("long").alias("place"), "line")
    for place, line in ((_FIRST, header), (_LAST, ""), (_LAST + 1, "Source: example survey")):
        data = data.unionByName(_fixed(spark, 1, place, F.lit(line)))
    return _files(data, name, 1)


def _decimal(c: Column, places: int) -> Column:
    """A whole number as text, divided by a power of ten."""
    return F.concat((c / F.lit(10 ** places)).cast("bigint").cast("string"), F.lit("."), F.lpad((c % F.lit(10 ** places)).cast("string"), places, "0"))


def _load_sources(spark: SparkSession, d: str):
    """The five sources of the load, from the driver's tables.  The two daily
    series are folders of exports, a file a scan task: no task gathers or
    sorts the line items."""
    from .pipeline import Sources

    dollars = F.concat(F.lit('"$'), _decimal(F.round(F.col("amt") * 100).cast("bigint"), 11), F.lit('"'))
    o = star.originations(spark, d).withColumn("amt", F.col("origination_amt"))
    orig = o.select(F.pmod(F.hash("quarter"), F.lit(1 << 30)).alias("place"), F.concat_ws(",", "quarter", dollars, _decimal(F.col("originations_cnt"), 6)).alias("line"))
    b = star.balances(spark, d).withColumn("amt", F.col("balance_amt"))
    bal = b.select(F.pmod(F.hash("quarter"), F.lit(1 << 30)).alias("place"), F.concat_ws(",", "quarter", dollars).alias("line"))

    def series_file(name: str, column: str) -> str:
        out = scratch_path(spark, f"{name.lower()}-{uuid.uuid4().hex}")
        rows = star.percent_series(spark, d, column).select(F.col("date").cast("string").alias("observation_date"), F.col("value").cast("int").alias(name))
        rows.write.option("header", True).csv(out)
        return out

    rate = F.concat(F.lit('<record><field name="Country or Area">United States</field><field name="Year">'), F.col("year").cast("string"),
                    F.lit('</field><field name="Value">'), F.col("lending_rate").cast("string"), F.lit("</field></record>"))
    xml = star.lending_yearly(spark, d).select(F.lit(0).alias("file"), F.col("year").cast("long").alias("place"), rate.alias("line"))
    for place, line in ((_FIRST, "<Root><data>"), (_LAST, "</data></Root>")):
        xml = xml.unionByName(_fixed(spark, 1, place, F.lit(line)))
    return Sources(
        originations=_one_file(spark, "orig", "YRQTR,New Originations ($Billions),Number of New Accounts (Millions)", orig),
        balances=_one_file(spark, "bal", '"YRQTR","Total Balances ($Billions)"', bal),
        prime_series=series_file("PRIME", "l_tax"), default_series=series_file("DELINQUENCY", "l_discount"),
        lending_records=_files(xml, "lend", 1))


@query("load_run", ORACLE_SQL["pipeline_fact"])
def load_run(spark, d):
    """The load itself, from files to the warehouse: CSV originations and
    balances, two daily series, lending records in XML.  A dry run first (it
    must write nothing), then the load."""
    from . import pipeline

    src, root = _load_sources(spark, d), scratch_path(spark, f"load-{uuid.uuid4().hex}")
    pipeline.run(spark, src, root, dry_run=True)
    wh = warehouse.Warehouse(spark, root)
    if wh.snapshots.exists():
        raise AssertionError("a dry run wrote to the warehouse")
    pipeline.run(spark, src, root)
    return wh.read("fact_credit_metrics_qtr")


__all__ = ["csv_balances", "csv_scan", "footer_stats", "load_run", "rejects_file", "report_document", "schema_generations", "series_exports", "xml_records"]
