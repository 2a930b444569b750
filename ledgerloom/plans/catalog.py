"""The query catalogue on the driver's tables (one entry per operator group).

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built with the
library's operators; ``ORACLE_SQL[name]`` states the same result in plain
SQL over the same tables.  Every query reads whole tables.  Where a value is
made "dirty" on purpose (a money string, a quarter layout, a missing or
negative value) the variant follows from the row's own key; the queries
whose feature is to drop unreadable rows (``normalize_quarter``,
``parse_quarter``, ``observation_clean``) then drop those, as they must.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import money, quarter
from ..operators import enrich, fill, quality, reports, warehouse
from ..session import scratch_path
from ..sources import csv_files, records, series
from . import marts, star
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


T = star.table


def _money_text(c: str) -> F.Column:
    return F.concat(F.lit("$"), F.format_number(F.col(c), 2))


# ------------------------------------------------------------ F1–F4, F5–F7
@query("clean_money", """
SELECT c_custkey, '$' || format('{:,.2f}', c_acctbal) AS balance_text,
       """ + O.to_float("'$' || format('{:,.2f}', c_acctbal)") + """ AS balance
FROM customer""")
def clean_money(spark, d):
    c = T(spark, d, "customer").select("c_custkey", _money_text("c_acctbal").alias("balance_text"))
    return c.withColumn("balance", money.to_float("balance_text"))


_DIRTY_SQL = """CASE c_custkey % 10
  WHEN 0 THEN '$' || format('{:,.2f}', c_acctbal)
  WHEN 1 THEN format('{:,.2f}', c_acctbal) || ' %'
  WHEN 2 THEN 'null' WHEN 3 THEN 'None' WHEN 4 THEN '' WHEN 5 THEN '.'
  WHEN 6 THEN 'nan'
  WHEN 7 THEN format('{:,.2f}', c_acctbal) || 'd'
  WHEN 8 THEN '  $' || format('{:,.2f}', c_acctbal) || '  '
  ELSE 'inf' END"""


@query("clean_money_dirty", f"""
SELECT c_custkey, raw_text, {O.to_float('raw_text')} AS value
FROM (SELECT c_custkey, {_DIRTY_SQL} AS raw_text FROM customer)""")
def clean_money_dirty(spark, d):
    fmt = F.format_number(F.col("c_acctbal"), 2)
    k = F.col("c_custkey") % 10
    raw = (F.when(k == 0, F.concat(F.lit("$"), fmt)).when(k == 1, F.concat(fmt, F.lit(" %")))
           .when(k == 2, F.lit("null")).when(k == 3, F.lit("None")).when(k == 4, F.lit(""))
           .when(k == 5, F.lit(".")).when(k == 6, F.lit("nan")).when(k == 7, F.concat(fmt, F.lit("d")))
           .when(k == 8, F.concat(F.lit("  $"), fmt, F.lit("  "))).otherwise(F.lit("inf")))
    c = T(spark, d, "customer").select("c_custkey", raw.alias("raw_text"))
    return c.withColumn("value", money.to_float("raw_text"))


_FRAC_SQL = "lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0')"


@query("scale_units", f"""
SELECT p_partkey,
       {O.to_float("'$' || CAST(p_size AS VARCHAR) || '.' || " + _FRAC_SQL)} * 1000000000.0 AS origination_amt,
       CAST({O.to_float("'$' || CAST(p_size AS VARCHAR) || '.' || " + _FRAC_SQL)} * 1000000000.0 AS DECIMAL(18,2)) AS origination_amt_dec,
       CAST(round({O.to_float("CAST(p_size AS VARCHAR) || '.' || " + _FRAC_SQL)} * 1000000.0) AS BIGINT) AS originations_cnt
FROM part""")
def scale_units(spark, d):
    frac = F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0")
    num = F.concat(F.col("p_size").cast("string"), F.lit("."), frac)
    p = T(spark, d, "part").select("p_partkey", F.concat(F.lit("$"), num).alias("bil"), num.alias("mil"))
    amt = money.billions_to_amount("bil")
    return p.select("p_partkey", amt.alias("origination_amt"),
                    money.cast_measure(amt, "origination_amt").alias("origination_amt_dec"),
                    money.millions_to_count("mil").alias("originations_cnt"))


_LAYOUT_SQL = """CASE o_orderkey % 5
  WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)
  WHEN 1 THEN ' ' || CAST(year(o_orderdate) AS VARCHAR) || ' q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' '
  WHEN 2 THEN 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || '  ' || CAST(year(o_orderdate) AS VARCHAR)
  WHEN 3 THEN 'q' || CAST(quarter(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR)
  ELSE CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) END"""


def _raw_quarters(spark, d) -> DataFrame:
    """Order dates written in four quarter layouts plus one invalid one."""
    y = F.year("o_orderdate").cast("string")
    q = F.quarter("o_orderdate").cast("string")
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, F.concat(y, F.lit("Q"), q))
           .when(k == 1, F.concat(F.lit(" "), y, F.lit(" q"), q, F.lit(" ")))
           .when(k == 2, F.concat(F.lit("Q"), q, F.lit("  "), y))
           .when(k == 3, F.concat(F.lit("q"), q, y))
           .otherwise(F.concat(y, F.lit("-Q"), q)))
    return T(spark, d, "orders").select("o_orderkey", raw.alias("quarter"))


@query("normalize_quarter", f"""
SELECT quarter_token, COUNT(*) AS n FROM (
  SELECT {O.normalize_quarter('raw')} AS quarter_token FROM (SELECT {_LAYOUT_SQL} AS raw FROM orders))
WHERE quarter_token IS NOT NULL GROUP BY 1""")
def normalize_quarter(spark, d):
    t = _raw_quarters(spark, d).select(quarter.normalize_quarter("quarter").alias("quarter_token"))
    return t.where(F.col("quarter_token").isNotNull()).groupBy("quarter_token").agg(F.count(F.lit(1)).alias("n"))


@query("parse_quarter", f"""
SELECT o_orderkey, raw AS quarter, {O.quarter_cols('tok')} FROM (
  SELECT o_orderkey, raw, {O.normalize_quarter('raw')} AS tok FROM (SELECT o_orderkey, {_LAYOUT_SQL} AS raw FROM orders))
WHERE tok IS NOT NULL""")
def parse_quarter(spark, d):
    return quarter.add_year_quarter(_raw_quarters(spark, d))


# ------------------------------------------------------------- S2, S3, S5
@query("contract_projection", f"""
SELECT {O.token('o_orderdate')} AS quarter,
       {O.to_float("'$' || CAST(o_custkey AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')")} * 1000000000.0 AS origination_amt,
       CAST(round({O.to_float("CAST(o_custkey % 1000 AS VARCHAR)")} * 1000000.0) AS BIGINT) AS originations_cnt
FROM orders""")
def contract_projection(spark, d):
    o = T(spark, d, "orders")
    raw = o.select(
        quarter.date_quarter_token("o_orderdate").alias(' "YRQTR" '),
        F.concat(F.lit("$"), F.col("o_custkey").cast("string"), F.lit("."),
                 F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")).alias("New Originations ($Billions) "),
        (F.col("o_custkey") % 1000).cast("string").alias('"Number of New Accounts (Millions)"'),
        F.col("o_orderpriority").alias("Original Credit Score (10th percentile)"),
        F.col("o_orderstatus").alias("Average Original Purchase APR: General Purpose"),
    )
    projected = csv_files.contract_projection(raw, C.ORIGINATION_COLUMNS)
    return csv_files.originations_from_text(projected)


@query("observation_clean", """
SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date, CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS value
FROM events
WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0""")
def observation_clean(spark, d):
    e = T(spark, d, "events")
    raw = e.select(
        F.col("user_id").cast("string").alias("Series"),
        F.when(F.col("event_id") % 7 == 0, F.lit("not a date"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias(" Observation_Date "),
        F.col("event_type").alias("Event_Type"),
        F.when(F.col("event_id") % 11 == 0, F.lit("n/a")).when(F.col("event_id") % 13 == 0, F.lit("."))
         .otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string")).alias("Prime_Rate"),
    )
    return series.series_from_frame(raw, series_col="Series")


# -------------------------------------------------------------- A1, A2, S6
@query("quarterly_mean", O.with_(O.PQ) + "SELECT quarter_key, year, quarter, prime_rate FROM pq")
def quarterly_mean(spark, d):
    return star.prime_quarterly(spark, d)


@query("percent_to_fraction", O.with_(O.DQ) + "SELECT year, quarter_num, default_rate FROM dq")
def percent_to_fraction(spark, d):
    return star.default_quarterly(spark, d)


@query("kv_records", """
SELECT CAST(year(ts) AS INTEGER) AS year, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS lending_rate
FROM events
WHERE event_type = 'purchase' AND TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL""")
def kv_records(spark, d):
    e = T(spark, d, "events")
    kv = F.transform_keys(F.from_json("props", "map<string,string>"),
                          lambda k, v: F.when(k == "k", F.lit("value")).otherwise(k))
    extra = F.create_map(
        F.lit("Country or Area"), F.when(F.col("event_id") % 9 == 0, F.lit("")).otherwise(F.col("event_type")),
        F.lit("Country"), F.col("event_type"),
        F.lit("Year"), F.when(F.col("event_id") % 6 == 0, F.lit(None)).otherwise(F.year("ts").cast("string")),
        F.lit("date"), F.date_format("ts", "yyyy"),
    )
    recs = e.select(F.map_concat(kv, extra).alias("kv"))
    return records.lending_yearly(recs, country="purchase")


@query("missing_source", O.with_(O.ORIG, O.BAL, O.BASE) + """
SELECT quarter_key, CAST(NULL AS DOUBLE) AS default_rate, CAST(NULL AS DOUBLE) AS prime_rate FROM base""")
def missing_source(spark, d):
    b = star.base(spark, d)
    empty_default = csv_files.empty_frame(spark, C.DEFAULT_QUARTERLY)
    out = enrich.attach(b, empty_default, ["year", "quarter_num"], ["default_rate"])
    out = enrich.attach(out, None, ["quarter_key"], ["prime_rate"])
    return out.select("quarter_key", "default_rate", "prime_rate")


# ------------------------------------------------------- W-2, Q1, Q2, W-3
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]
_LINE_ORDER_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in LINE_ORDER)


@query("dedupe_keep_first", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_SQL}) AS rn FROM lineitem)
WHERE rn = 1""")
def dedupe_keep_first(spark, d):
    return quality.keep_first(T(spark, d, "lineitem"), LINE_KEY, ["l_shipdate"])


@query("dedupe_rejects", f"""
SELECT l_orderkey, l_linenumber, 'lineitem_duplicate_keys' AS dq_reason FROM (
  SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_SQL}) AS rn
  FROM lineitem)
WHERE rn > 1""")
def dedupe_rejects(spark, d):
    return quality.duplicate_key_rejects(T(spark, d, "lineitem"), LINE_KEY, "lineitem_duplicate_keys")


_ORDER_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("final_grain_dedupe", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY """ + ", ".join(f"{c} ASC NULLS FIRST" for c in _ORDER_ORDER) + """) AS rn
  FROM lineitem)
WHERE rn = 1""")
def final_grain_dedupe(spark, d):
    return quality.keep_first(T(spark, d, "lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber"])


# --------------------------------------------------------- J1–J4, J8, P4
@query("enrich_balances", O.with_(O.ORIG, O.BAL, O.BASE) + "SELECT * FROM base")
def enrich_balances(spark, d):
    return star.base(spark, d)


@query("enrich_rates", O.with_(O.ORIG, O.BAL, O.BASE, O.DQ, O.PQ, O.LY, O.ENRICHED) + "SELECT * FROM enriched")
def enrich_rates(spark, d):
    return star.enriched_base(spark, d)


@query("fanout_guard", O.with_(O.ORIG, O.BAL, O.BASE, O.DQ, O.PQ, O.LY) + """,
lc AS (SELECT 'default_q' AS label, year AS k1, quarter_num AS k2, COUNT(*) AS n FROM base GROUP BY 2, 3
       UNION ALL SELECT 'prime', quarter_key, 0, COUNT(*) FROM base GROUP BY 2
       UNION ALL SELECT 'lending', year, 0, COUNT(*) FROM base GROUP BY 2
       UNION ALL SELECT 'shipments', year(o_orderdate) * 10 + quarter(o_orderdate), 0, COUNT(*) FROM orders GROUP BY 2),
rc AS (SELECT 'default_q' AS label, year AS k1, quarter_num AS k2, COUNT(*) AS n FROM dq GROUP BY 2, 3
       UNION ALL SELECT 'prime', quarter_key, 0, COUNT(*) FROM pq GROUP BY 2
       UNION ALL SELECT 'lending', year, 0, COUNT(*) FROM ly GROUP BY 2
       UNION ALL SELECT 'shipments', year(l_shipdate) * 10 + quarter(l_shipdate), 0, COUNT(*) FROM lineitem GROUP BY 2),
t AS (SELECT lc.label, SUM(lc.n) AS before_rows, CAST(SUM(CAST(lc.n AS HUGEINT) * COALESCE(rc.n, 1)) AS DECIMAL(38,0)) AS after_rows
      FROM lc LEFT JOIN rc ON lc.label = rc.label AND lc.k1 = rc.k1 AND lc.k2 = rc.k2 GROUP BY lc.label)
SELECT label, CAST(before_rows AS BIGINT) AS before_rows, after_rows,
       CASE WHEN before_rows > 0 THEN CAST(after_rows AS DOUBLE) / CAST(before_rows AS DOUBLE) END AS ratio,
       COALESCE(CAST(after_rows AS DOUBLE) / CAST(before_rows AS DOUBLE) > 1.01, false) AS fanout_warn
FROM t""")
def fanout_guard(spark, d):
    # The base holds one row per quarter and feeds three checks: materialise
    # it once instead of re-reading orders and line items per check.
    ship = star.ship_quarters(spark, d)
    b = star.base(spark, d, ship).checkpoint(eager=True)
    o = T(spark, d, "orders").select(quarter.date_quarter_token("o_orderdate").alias("quarter"))
    li = T(spark, d, "lineitem").select(quarter.date_quarter_token("l_shipdate").alias("quarter"))
    parts = [
        enrich.fanout_report(b, star.default_quarterly(spark, d, ship), ["year", "quarter_num"], "default_q"),
        enrich.fanout_report(b, star.prime_quarterly(spark, d, ship), ["quarter_key"], "prime"),
        enrich.fanout_report(b, star.lending_yearly(spark, d, ship), ["year"], "lending"),
        enrich.fanout_report(o, li, ["quarter"], "shipments"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- Q3, Q4
def _range_input(spark, d) -> DataFrame:
    return T(spark, d, "lineitem").select(*LINE_KEY, (F.col("l_discount") * F.lit(20.0)).alias("default_rate"))


@query("range_gate", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN (l_discount * 20.0) BETWEEN 0 AND 1 THEN l_discount * 20.0 END AS default_rate
FROM lineitem""")
def range_gate(spark, d):
    return quality.range_gate(_range_input(spark, d), "default_rate", keep_cols=LINE_KEY + ["default_rate"])[0]


_RANGE_REJ_SQL = """
SELECT l_orderkey, l_linenumber, l_discount * 20.0 AS default_rate, 'default_rate_out_of_range' AS dq_reason
FROM lineitem WHERE NOT ((l_discount * 20.0) BETWEEN 0 AND 1)"""


@query("range_rejects", _RANGE_REJ_SQL)
def range_rejects(spark, d):
    return quality.range_gate(_range_input(spark, d), "default_rate", keep_cols=LINE_KEY + ["default_rate"])[1]


def _nonneg_input(spark, d) -> DataFrame:
    return T(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance_amt"))


@query("nonneg_gate", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance_amt FROM customer""")
def nonneg_gate(spark, d):
    return quality.nonneg_gate(_nonneg_input(spark, d), key_cols=["c_custkey"])[0]


_NONNEG_REJ_SQL = """
SELECT c_custkey, c_acctbal AS balance_amt, 'negative_balance_amt' AS dq_reason FROM customer WHERE c_acctbal < 0"""


@query("nonneg_rejects", _NONNEG_REJ_SQL)
def nonneg_rejects(spark, d):
    return quality.nonneg_gate(_nonneg_input(spark, d), key_cols=["c_custkey"])[1]


@query("reject_union", f"""
SELECT l_orderkey, l_linenumber, CAST(NULL AS DOUBLE) AS default_rate, CAST(NULL AS BIGINT) AS c_custkey,
       CAST(NULL AS DOUBLE) AS balance_amt, dq_reason
FROM ({ORACLE_SQL['dedupe_rejects']})
UNION ALL
SELECT l_orderkey, l_linenumber, default_rate, NULL, NULL, dq_reason FROM ({_RANGE_REJ_SQL})
UNION ALL
SELECT NULL, NULL, NULL, c_custkey, balance_amt, dq_reason FROM ({_NONNEG_REJ_SQL})""")
def reject_union(spark, d):
    return quality.union_rejects(dedupe_rejects(spark, d), range_rejects(spark, d), nonneg_rejects(spark, d))


@query("precision_rejects", """
SELECT l_orderkey, l_linenumber, l_quantity AS default_rate, 'default_rate_out_of_contract' AS dq_reason
FROM lineitem WHERE l_quantity IS NOT NULL AND TRY_CAST(l_quantity AS DECIMAL(6,5)) IS NULL""")
def precision_rejects(spark, d):
    rows = T(spark, d, "lineitem").select(*LINE_KEY, F.col("l_quantity").alias("default_rate"))
    return quality.precision_gate(rows, ["default_rate"], LINE_KEY)[1]


@query("reject_summary", f"""
SELECT dq_reason, COUNT(*) AS reject_rows FROM ({ORACLE_SQL['reject_union']}) GROUP BY 1""")
def reject_summary(spark, d):
    return quality.reject_summary(reject_union(spark, d))


# --------------------------------------------------------------- W-1, Q5
@query("ffill_in_group", """
SELECT event_id, user_id, CAST(ts AS DATE) AS day,
       last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (
         PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM events""")
def ffill_in_group(spark, d):
    e = T(spark, d, "events").select(
        "event_id", "user_id", F.col("ts"), F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    out = fill.forward_fill(e, ["value"], ["user_id", "day"], ["ts", "event_id"])
    return out.select("event_id", "user_id", "day", "value")


@query("gated_base", O.with_(O.ORIG, O.BAL, O.BASE, O.DQ, O.PQ, O.LY, O.ENRICHED) + """,
gated AS (
  SELECT * REPLACE (
    CASE WHEN default_rate BETWEEN 0 AND 1 OR default_rate IS NULL THEN default_rate END AS default_rate,
    CASE WHEN originations_cnt < 0 THEN NULL ELSE originations_cnt END AS originations_cnt,
    CASE WHEN origination_amt < 0 THEN NULL ELSE origination_amt END AS origination_amt,
    CASE WHEN balance_amt < 0 THEN NULL ELSE balance_amt END AS balance_amt)
  FROM enriched)
SELECT * REPLACE (
  last_value(prime_rate IGNORE NULLS) OVER w AS prime_rate,
  last_value(lending_rate IGNORE NULLS) OVER w AS lending_rate)
FROM gated
WINDOW w AS (PARTITION BY year ORDER BY quarter_num, quarter_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def gated_base(spark, d):
    from .pipeline import gate_and_fill

    return gate_and_fill(star.enriched_base(spark, d))[0]


_GATED_SQL = ORACLE_SQL["gated_base"]


@query("pipeline_fact", f"""
SELECT quarter_key, CAST(1 AS INTEGER) AS geo_key, CAST(1 AS INTEGER) AS product_key,
       CAST(originations_cnt AS BIGINT) AS originations_cnt,
       CAST(origination_amt AS DECIMAL(18,2)) AS origination_amt,
       CAST(balance_amt AS DECIMAL(18,2)) AS balance_amt,
       CAST(default_rate AS DECIMAL(6,5)) AS default_rate,
       CAST(prime_rate AS DECIMAL(6,3)) AS prime_rate,
       CAST(lending_rate AS DECIMAL(6,3)) AS lending_rate
FROM ({_GATED_SQL})""")
def pipeline_fact(spark, d):
    """The load rows of the quarterly pipeline: gated, filled base with the
    single geo / product member's keys (W6, W7, F17)."""
    from . import pipeline
    from ..operators import keys

    base, _ = pipeline.gate_and_fill(star.enriched_base(spark, d))
    geo, _ = keys.get_or_create(spark.createDataFrame([], C.DIM_GEO),
                                spark.createDataFrame([C.DEFAULT_GEO], "country string, state_province string, city string"),
                                C.GEO_NATURAL_KEY, "geo_key")
    prod, _ = keys.get_or_create(spark.createDataFrame([], C.DIM_PRODUCT),
                                 spark.createDataFrame([C.DEFAULT_PRODUCT], "product_code string, product_type string, segment string"),
                                 C.PRODUCT_NATURAL_KEY, "product_key")
    return pipeline.fact_from_base(base, geo, prod)


# ------------------------------------------------------------ W2, J7, W6
@query("date_dim", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM) + "SELECT * FROM date_dim")
def date_dim(spark, d):
    return star.date_dim(spark, d)


@query("geo_keys", O.with_(O.STAR) + "SELECT geo_key, country, state_province, city FROM geo_dim")
def geo_keys(spark, d):
    return star.geo_dim(spark, d)


@query("product_keys", O.with_(O.STAR) + "SELECT product_key, product_code, product_type, segment FROM product_dim")
def product_keys(spark, d):
    return star.product_dim(spark, d)


# ------------------------------------------------------- W7, W4, W3, W5
@query("fact_build", O.with_(O.FACT) + "SELECT * FROM fact")
def fact_build(spark, d):
    return star.fact_rows(spark, d)


# The upsert examples split the data at its own middle quarter m: quarters up
# to m + 2 are loaded, a restated batch starts at m.
def _split(frame: DataFrame) -> tuple[F.Column, F.Column]:
    """(already loaded, restated) conditions on a frame's own quarters."""
    m, i = star.middle_quarter(frame), star.quarter_index("quarter_key")
    return i <= m + 2, i >= m


def _split_sql(frame: str) -> tuple[str, str]:
    i, m = O.qindex("quarter_key"), O.middle(frame)
    return f"{i} <= {m} + 2", f"{i} >= {m}"


def _restated(fact: DataFrame) -> DataFrame:
    """A restated batch: later quarters, rates not yet known (NULL)."""
    return fact.where(_split(fact)[1]).withColumns({
        "default_rate": F.lit(None).cast(C.MEASURE_TYPES["default_rate"]),
        "prime_rate": F.lit(None).cast(C.MEASURE_TYPES["prime_rate"]),
    })


_INCOMING_SQL = f"""incoming AS (
  SELECT * REPLACE (CAST(NULL AS DECIMAL(6,5)) AS default_rate, CAST(NULL AS DECIMAL(6,3)) AS prime_rate)
  FROM fact WHERE {_split_sql('fact')[1]}),
existing AS (SELECT * FROM fact WHERE {_split_sql('fact')[0]})"""


@query("fact_upsert", O.with_(O.FACT, _INCOMING_SQL) + """
SELECT * FROM existing e WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.quarter_key = e.quarter_key AND i.geo_key = e.geo_key AND i.product_key = e.product_key)
UNION ALL SELECT * FROM incoming""")
def fact_upsert(spark, d):
    # One row per cell, numbered and stamped once for every branch below.
    fact = star.fact_rows(spark, d).checkpoint(eager=True)
    return warehouse.fact_upsert_frame(fact.where(_split(fact)[0]), _restated(fact))


@query("fact_recreate", O.with_(O.FACT, _INCOMING_SQL) + "SELECT * FROM incoming")
def fact_recreate(spark, d):
    """W5 on a warehouse folder: a fact is written, then replaced by a batch
    that lacks its earlier quarters."""
    tables = star.star_tables(spark, d)
    wh = warehouse.Warehouse(spark, scratch_path(spark, f"recreate-{uuid.uuid4().hex}"))
    for name in ("dim_date_qtr", "dim_geo", "dim_product"):
        wh._write(tables[name], name, static=True)
    fact = tables["fact_credit_metrics_qtr"].checkpoint(eager=True)
    wh.recreate_fact(fact.where(_split(fact)[0]))
    wh.recreate_fact(_restated(fact))
    return wh.read("fact_credit_metrics_qtr")


class _Killed(Exception):
    """Stands for a driver that is lost in the middle of a load."""


@query("load_interrupted", O.with_(O.FACT, _INCOMING_SQL) + """
SELECT 'killed' AS load, * FROM existing
UNION ALL SELECT 'rerun', * FROM existing e WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.quarter_key = e.quarter_key AND i.geo_key = e.geo_key AND i.product_key = e.product_key)
UNION ALL SELECT 'rerun', * FROM incoming""")
def load_interrupted(spark, d):
    """W3 / W4 / K5 with an atomic switch: a load is lost after it wrote all
    of its tables and before it published them (``killed``: what readers see
    then), and run again (``rerun``)."""
    tables = star.star_tables(spark, d)
    fact = tables.pop("fact_credit_metrics_qtr").checkpoint(eager=True)
    wh = warehouse.Warehouse(spark, scratch_path(spark, f"interrupted-{uuid.uuid4().hex}"))

    def load(rows: DataFrame, killed: bool = False) -> DataFrame:
        with wh.load():
            for name, frame in tables.items():
                wh._write(frame, name, static=True)
            wh.upsert_fact(rows)
            if killed:
                raise _Killed
        return wh.read("fact_credit_metrics_qtr")

    load(fact.where(_split(fact)[0]))
    try:
        load(_restated(fact), killed=True)
    except _Killed:
        before = wh.read("fact_credit_metrics_qtr")
    after = load(_restated(fact))
    return before.select(F.lit("killed").alias("load"), "*").unionByName(after.select(F.lit("rerun").alias("load"), "*"))


_LINE_FACT_SQL = f"""lines AS (
  SELECT {O.qkey('l_shipdate')} AS quarter_key, CAST(l_suppkey AS INTEGER) AS geo_key, CAST(1 AS INTEGER) AS product_key,
         CAST(l_quantity AS BIGINT) AS originations_cnt, CAST(l_extendedprice AS DECIMAL(18,2)) AS origination_amt,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""


def _line_facts(spark, d) -> DataFrame:
    """Line items as fact rows with a load order; keys repeat."""
    return T(spark, d, "lineitem").select(
        quarter.quarter_key(F.year("l_shipdate"), F.quarter("l_shipdate")).alias("quarter_key"),
        F.col("l_suppkey").cast("int").alias("geo_key"), F.least("l_linenumber", F.lit(1)).cast("int").alias("product_key"),
        F.col("l_quantity").cast("bigint").alias("originations_cnt"), F.col("l_extendedprice").cast("decimal(18,2)").alias("origination_amt"),
        "l_orderkey", "l_linenumber", "l_partkey")


_LOAD_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "originations_cnt", "origination_amt")


@query("upsert_duplicate_keys", O.with_(_LINE_FACT_SQL) + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY quarter_key, geo_key, product_key ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _LOAD_ORDER)}) AS rn FROM lines)
WHERE rn = 1""")
def upsert_duplicate_keys(spark, d):
    return quality.last_per_key(_line_facts(spark, d), C.FACT_KEY, _LOAD_ORDER, "fact_superseded")[0]


@query("load_rejects", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM, _LINE_FACT_SQL) + """,
keyed AS (SELECT CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN -geo_key - 1 ELSE geo_key END AS geo_key, quarter_key, product_key, l_orderkey FROM lines),
known AS (SELECT * FROM keyed WHERE geo_key IS NOT NULL),
dated AS (SELECT * FROM known WHERE quarter_key IN (SELECT quarter_key FROM date_dim)),
placed AS (SELECT * FROM dated WHERE geo_key IN (SELECT s_suppkey FROM supplier))
SELECT quarter_key, geo_key, product_key, 'null_geo_key' AS dq_reason FROM keyed WHERE geo_key IS NULL
UNION ALL SELECT quarter_key, geo_key, product_key, 'quarter_key_orphan' FROM known WHERE quarter_key NOT IN (SELECT quarter_key FROM date_dim)
UNION ALL SELECT quarter_key, geo_key, product_key, 'geo_key_orphan' FROM dated WHERE geo_key NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT quarter_key, geo_key, product_key, 'fact_superseded' FROM (
  SELECT *, row_number() OVER (PARTITION BY quarter_key, geo_key, product_key ORDER BY l_orderkey DESC) AS rn FROM placed) WHERE rn > 1""")
def load_rejects(spark, d):
    """W9 + J9: what the load checks set apart.  Some line facts lack their
    geo key, others have one that no supplier has; the ship quarters reach
    beyond the order quarters."""
    part = F.col("l_partkey")
    geo_key = F.when(part % 50 == 0, F.lit(None)).when(part % 7 == 0, -F.col("geo_key") - 1).otherwise(F.col("geo_key"))
    rows = _line_facts(spark, d).withColumn("geo_key", geo_key.cast("int"))
    geo = T(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("geo_key"))
    dims = {"dim_date_qtr": star.date_dim(spark, d), "dim_geo": geo,
            "dim_product": spark.range(1, 2).select(F.col("id").cast("int").alias("product_key"))}
    return warehouse.load_checks(rows, dims, _LOAD_ORDER)[1]


@query("dim_upsert", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM) + f"""
SELECT quarter_key, year, quarter, quarter_start, quarter_start AS quarter_end FROM date_dim
WHERE {_split_sql('date_dim')[0]} AND NOT ({_split_sql('date_dim')[1]})
UNION ALL SELECT * FROM date_dim WHERE {_split_sql('date_dim')[1]}""")
def dim_upsert(spark, d):
    # One row per quarter, read by every branch of the merge: written once.
    dd = star.date_dim(spark, d).checkpoint(eager=True)
    loaded, restated = _split(dd)
    stale = dd.where(loaded).withColumn("quarter_end", F.col("quarter_start"))
    return warehouse.merge_upsert(stale, dd.where(restated), ["quarter_key"])


@query("schema_heal", """
SELECT CAST(p_partkey AS INTEGER) AS product_key, CAST(NULL AS VARCHAR) AS product_code,
       CAST(NULL AS VARCHAR) AS product_type, CAST(NULL AS VARCHAR) AS segment, p_size AS product_number
FROM part""")
def schema_heal(spark, d):
    legacy = T(spark, d, "part").select(F.col("p_partkey").cast("int").alias("product_key"),
                                        F.col("p_size").alias("product_number"))
    return warehouse.align_to_contract(legacy, C.DIM_PRODUCT)


# ------------------------------------------------------------ J9, W9
@query("fk_orphans", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM) + f"""
SELECT l_orderkey, l_linenumber, {O.qkey('l_shipdate')} AS quarter_key FROM lineitem
WHERE {O.qkey('l_shipdate')} NOT IN (SELECT quarter_key FROM date_dim)""")
def fk_orphans(spark, d):
    li = T(spark, d, "lineitem").select(
        *LINE_KEY, quarter.quarter_key(F.year("l_shipdate"), F.quarter("l_shipdate")).alias("quarter_key"))
    return warehouse.fk_orphans(li, star.date_dim(spark, d), "quarter_key")


@query("pk_violations", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def pk_violations(spark, d):
    return warehouse.pk_violations(T(spark, d, "lineitem"), LINE_KEY)


@query("not_null_violations", O.with_(O.MEMBERS) + """
SELECT 'members' AS table_name, column_name, null_rows FROM (
  SELECT 'quarter_key' AS column_name, COUNT(*) FILTER (WHERE quarter_key IS NULL) AS null_rows FROM members
  UNION ALL SELECT 'default_rate', COUNT(*) FILTER (WHERE default_rate IS NULL) FROM members
  UNION ALL SELECT 'prime_rate', COUNT(*) FILTER (WHERE prime_rate IS NULL) FROM members)""")
def not_null_violations(spark, d):
    return warehouse.not_null_violations(star.member_base(spark, d), ["quarter_key", "default_rate", "prime_rate"], "members")


# ------------------------------------------------------ R1–R7, A5–A10
@query("source_counts", O.with_(O.DQ, O.PQ, O.LY) + """
SELECT 'orig_rows' AS source, COUNT(*) AS rows FROM orders
UNION ALL SELECT 'bal_rows', COUNT(*) FROM lineitem
UNION ALL SELECT 'prime_rows', COUNT(*) FROM pq
UNION ALL SELECT 'dfltq_rows', COUNT(*) FROM dq
UNION ALL SELECT 'lendy_rows', COUNT(*) FROM ly""")
def source_counts(spark, d):
    ship = star.ship_quarters(spark, d)
    return reports.source_counts({
        "orig_rows": T(spark, d, "orders"), "bal_rows": T(spark, d, "lineitem"),
        "prime_rows": star.prime_quarterly(spark, d, ship), "dfltq_rows": star.default_quarterly(spark, d, ship),
        "lendy_rows": star.lending_yearly(spark, d, ship),
    })


@query("table_counts", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM, O.FACT) + """
SELECT 'dim_date_qtr' AS table_name, COUNT(*) AS cnt FROM date_dim
UNION ALL SELECT 'dim_geo', COUNT(*) FROM geo_dim
UNION ALL SELECT 'dim_product', COUNT(*) FROM product_dim
UNION ALL SELECT 'fact_credit_metrics_qtr', COUNT(*) FROM fact""")
def table_counts(spark, d):
    return warehouse.table_counts(star.star_tables(spark, d))


_ENRICHED = O.with_(O.ORIG, O.BAL, O.BASE, O.DQ, O.PQ, O.LY, O.ENRICHED)


@query("coverage", _ENRICHED + """
SELECT min(year) AS min_year, max(year) AS max_year, min(quarter_key) AS min_quarter_key,
       max(quarter_key) AS max_quarter_key, COUNT(*) AS rows_after_merge
FROM enriched HAVING COUNT(*) > 0""")
def coverage(spark, d):
    return reports.coverage(star.enriched_base(spark, d))


_MEMBERS = O.with_(O.MEMBERS)


def _profile_sql() -> str:
    parts = []
    for c in C.MEASURES:
        parts.append(f"""SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS "null",
       CASE WHEN COUNT(*) = 0 THEN 0.0::DOUBLE ELSE {O.half_even(f'(COUNT(*) - COUNT({c})) * 100', 'COUNT(*)', 2)} END AS null_pct
FROM members""")
    return _MEMBERS + "\nUNION ALL\n".join(parts)


@query("null_profile", _profile_sql())
def null_profile(spark, d):
    return reports.null_profile(star.member_base(spark, d))


@query("null_rates", _MEMBERS + "SELECT COUNT(*) AS rows, " + ", ".join(
    f"CASE WHEN COUNT(*) > 0 THEN {O.half_up(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)', 3)} END AS null_rate_{c}"
    for c in C.MEASURES) + """,
  COUNT(*) FILTER (WHERE NOT (default_rate BETWEEN 0 AND 1 OR default_rate IS NULL)) AS range_bad_default
FROM members""")
def null_rates(spark, d):
    return reports.validate_report(star.member_base(spark, d))


@query("violations", _MEMBERS + """
SELECT 'default_rate_out_of_range' AS rule, COUNT(*) FILTER (WHERE default_rate < 0 OR default_rate > 1) AS violations FROM members
UNION ALL SELECT 'neg_originations_cnt', COUNT(*) FILTER (WHERE originations_cnt < 0) FROM members
UNION ALL SELECT 'neg_origination_amt', COUNT(*) FILTER (WHERE origination_amt < 0) FROM members
UNION ALL SELECT 'neg_balance_amt', COUNT(*) FILTER (WHERE balance_amt < 0) FROM members""")
def violations(spark, d):
    return reports.violations(star.member_base(spark, d))


@query("dup_keys", _MEMBERS + """
SELECT COUNT(*) FILTER (WHERE c > 1) AS dupes_on_quarter_key FROM (SELECT member, quarter_key, COUNT(*) AS c FROM members GROUP BY 1, 2)""")
def dup_keys(spark, d):
    return reports.dup_keys(star.member_base(spark, d), ["member", "quarter_key"])


# Gates, fill and final dedupe on a base that needs all of them.
@query("member_gated_base", O.with_(O.MEMBERS) + """,
gated AS (
  SELECT * REPLACE (
    CASE WHEN default_rate BETWEEN 0 AND 1 THEN default_rate END AS default_rate,
    CASE WHEN originations_cnt >= 0 THEN originations_cnt END AS originations_cnt,
    CASE WHEN origination_amt >= 0 THEN origination_amt END AS origination_amt,
    CASE WHEN balance_amt >= 0 THEN balance_amt END AS balance_amt)
  FROM members),
filled AS (
  SELECT * REPLACE (last_value(prime_rate IGNORE NULLS) OVER w AS prime_rate, last_value(lending_rate IGNORE NULLS) OVER w AS lending_rate)
  FROM gated WINDOW w AS (PARTITION BY member, year ORDER BY quarter_num, quarter_key, copy_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY member, quarter_key ORDER BY year, quarter_num, copy_no) AS rn FROM filled)
WHERE rn = 1""")
def member_gated_base(spark, d):
    from .pipeline import gate_and_fill

    return gate_and_fill(star.member_base(spark, d), ("member",), ("copy_no",))[0]


@query("member_rejects", O.with_(O.MEMBERS) + """
SELECT dq_reason, COUNT(*) AS reject_rows FROM (
  SELECT 'default_rate_out_of_range' AS dq_reason FROM members WHERE default_rate < 0 OR default_rate > 1
  UNION ALL SELECT 'negative_originations_cnt' FROM members WHERE originations_cnt < 0
  UNION ALL SELECT 'negative_origination_amt' FROM members WHERE origination_amt < 0
  UNION ALL SELECT 'negative_balance_amt' FROM members WHERE balance_amt < 0)
GROUP BY 1""")
def member_rejects(spark, d):
    from .pipeline import gate_and_fill

    return quality.reject_summary(gate_and_fill(star.member_base(spark, d), ("member",), ("copy_no",))[1])


# -------------------------------------------------------------- W10, W11
_PER_QUARTER_SQL = """,
per AS (
  SELECT quarter_key, SUM(originations_cnt) AS c, SUM(origination_amt) AS o, SUM(balance_amt) AS b, SUM(default_rate) AS ds,
         COUNT(default_rate) AS dn, SUM(prime_rate) AS ps, COUNT(prime_rate) AS pn
  FROM fact GROUP BY quarter_key),
calendar AS (SELECT per.*, date_dim.year, date_dim.quarter FROM per JOIN date_dim USING (quarter_key))
"""


@query("trend", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM, O.FACT) + _PER_QUARTER_SQL + """
SELECT year, quarter, CAST(SUM(o) AS DECIMAL(38,2)) AS orig_amt_usd, CAST(SUM(b) AS DECIMAL(38,2)) AS balance_usd,
       CAST(SUM(ds) AS DOUBLE) / SUM(dn) AS default_rate
FROM calendar GROUP BY 1, 2 ORDER BY 1, 2""")
def trend(spark, d):
    return marts.trend(star.fact_measures(spark, d), star.date_dim(spark, d))


@query("yearly", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM, O.FACT) + _PER_QUARTER_SQL + """
SELECT year, CAST(SUM(c) AS BIGINT) AS cnt, CAST(SUM(o) AS DECIMAL(38,2)) AS amt, CAST(SUM(ps) AS DOUBLE) / SUM(pn) AS avg_prime
FROM calendar GROUP BY 1""")
def yearly(spark, d):
    return marts.yearly(star.fact_measures(spark, d), star.date_dim(spark, d))


@query("trend_sql", O.with_(O.ORIG, O.BAL, O.BASE, O.DATE_DIM, O.FACT) + _PER_QUARTER_SQL + """
SELECT year, quarter, CAST(SUM(o) AS DECIMAL(38,2)) AS orig_amt_usd, CAST(SUM(b) AS DECIMAL(38,2)) AS balance_usd,
       CAST(SUM(ds) AS DOUBLE) / SUM(dn) AS default_rate
FROM calendar WHERE year BETWEEN (SELECT max(year) - 1 FROM date_dim) AND (SELECT max(year) FROM date_dim)
GROUP BY 1, 2 ORDER BY 1, 2""")
def trend_sql(spark, d):
    """W1 + W10: the star is loaded into a warehouse folder, registered in the
    catalog, and asked in SQL for its last two years; the year is a filter on
    the date dimension."""
    wh = warehouse.Warehouse(spark, scratch_path(spark, f"mart-{uuid.uuid4().hex}"))
    with wh.load():
        for name, frame in star.star_tables(spark, d).items():
            wh._write(frame, name, static=True)
    db = f"mart_{uuid.uuid4().hex}"
    warehouse.register_tables(spark, wh.root, db)
    last = f"(SELECT MAX(year) FROM `{db}`.dim_date_qtr)"
    return marts.sql_query(spark, marts.TREND_YEARS_SQL, db, first=f"{last} - 1", last=last)


from . import load_queries  # noqa: E402, F401  (registers the queries of the load's files)
