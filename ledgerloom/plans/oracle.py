"""Independent ANSI-SQL statements of the catalogue queries.

Each statement computes, directly from the driver's tables, what the Spark
query computes with the library's operators; the check harness runs them in
DuckDB against the same Parquet files and compares the results.  Shared
building blocks are common table expressions.
"""

from __future__ import annotations


def token(ts: str) -> str:
    return f"(CAST(year({ts}) AS VARCHAR) || 'Q' || CAST(quarter({ts}) AS VARCHAR))"


def qkey(ts: str) -> str:
    return f"CAST(year({ts}) * 10 + quarter({ts}) AS INTEGER)"


def round_int(x: str) -> str:
    """Half away from zero, as floor(|x| + 0.5) with the sign restored."""
    return f"CAST(CASE WHEN ({x}) >= 0 THEN floor(({x}) + 0.5) ELSE -floor(-({x}) + 0.5) END AS BIGINT)"


def cents(x: str) -> str:
    return round_int(f"({x}) * 100.0")


def half_up(n: str, d: str, places: int) -> str:
    s = 10 ** places
    return f"(floor((CAST({n} AS BIGINT) * {2 * s} + CAST({d} AS BIGINT)) / (CAST({d} AS BIGINT) * 2)) / {float(s)})"


def half_even(n: str, d: str, places: int) -> str:
    """Exact halves to the even digit."""
    x, whole = f"(CAST({n} AS BIGINT) * {10 ** places})", f"(CAST({n} AS BIGINT) * {10 ** places} // CAST({d} AS BIGINT))"
    left = f"(({x} - {whole} * CAST({d} AS BIGINT)) * 2)"
    up = f"CASE WHEN {left} > CAST({d} AS BIGINT) OR ({left} = CAST({d} AS BIGINT) AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CAST({whole} + {up} AS DOUBLE) / {float(10 ** places)}::DOUBLE)"


NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_float(x: str) -> str:
    s = f"regexp_replace(CAST({x} AS VARCHAR), '[$,%]', '', 'g')"
    return (f"(CASE WHEN {s} IN ('null', 'None', '', '.') THEN NULL "
            f"WHEN regexp_matches({s}, '{NUMBER}') "
            f"THEN TRY_CAST(regexp_replace({s}, '^\\s+|\\s+$', '', 'g') AS DOUBLE) END)")


def normalize_quarter(x: str) -> str:
    t = (f"regexp_replace(replace(upper(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')), chr(65279), ''), "
         f"'\\s+', ' ', 'g')")
    yf, qf = "^([0-9]{4}) ?(Q[1-4])$", "^(Q[1-4]) ?([0-9]{4})$"
    return (f"(CASE WHEN regexp_matches({t}, '{yf}') THEN regexp_extract({t}, '{yf}', 1) || regexp_extract({t}, '{yf}', 2) "
            f"WHEN regexp_matches({t}, '{qf}') THEN regexp_extract({t}, '{qf}', 2) || regexp_extract({t}, '{qf}', 1) END)")


def quarter_cols(tok: str) -> str:
    y, q = f"CAST(substr({tok}, 1, 4) AS INTEGER)", f"CAST(substr({tok}, 6, 1) AS INTEGER)"
    return (f"{y} AS year, {q} AS quarter_num, make_date({y}, ({q} - 1) * 3 + 1, 1) AS quarter_start, "
            f"last_day(make_date({y}, {q} * 3, 1)) AS quarter_end, CAST({y} * 10 + {q} AS INTEGER) AS quarter_key")


ORIG = f"""orig AS (
  SELECT {token('o_orderdate')} AS quarter, COUNT(*) AS originations_cnt,
         CAST(SUM({cents('o_totalprice')}) AS DOUBLE) / 100.0 AS origination_amt
  FROM orders GROUP BY 1)"""

BAL = f"""bal AS (
  SELECT {token('l_shipdate')} AS quarter, CAST(SUM({cents('l_extendedprice')}) AS DOUBLE) / 100.0 AS balance_amt
  FROM lineitem GROUP BY 1)"""

BASE = f"""base AS (
  SELECT o.quarter, o.originations_cnt, o.origination_amt, b.balance_amt, {quarter_cols('o.quarter')}
  FROM orig o LEFT JOIN bal b ON o.quarter = b.quarter)"""

DQ = f"""dq AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter_num,
         avg(CAST({round_int('l_discount * 100.0')} AS DOUBLE)) / 100.0 AS default_rate
  FROM lineitem GROUP BY 1, 2)"""

PQ = f"""pq AS (
  SELECT {qkey('l_shipdate')} AS quarter_key, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(quarter(l_shipdate) AS INTEGER) AS quarter, avg(CAST({round_int('l_tax * 100.0')} AS DOUBLE)) AS prime_rate
  FROM lineitem GROUP BY 1, 2, 3)"""

LY = f"""ly AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(CAST({round_int('l_tax * 100.0')} AS DOUBLE)) AS lending_rate
  FROM lineitem GROUP BY 1)"""

ENRICHED = """enriched AS (
  SELECT b.*, dq.default_rate, pq.prime_rate, ly.lending_rate
  FROM base b
  LEFT JOIN dq ON b.year = dq.year AND b.quarter_num = dq.quarter_num
  LEFT JOIN pq ON b.quarter_key = pq.quarter_key
  LEFT JOIN ly ON b.year = ly.year)"""

DATE_DIM = """date_dim AS (
  SELECT DISTINCT quarter_key, year, quarter_num AS quarter, quarter_start, quarter_end FROM base)"""

GEO_LOOKUP = """geo_lookup AS (
  SELECT c_custkey, r_name AS country, n_name AS state_province
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def qindex(key: str) -> str:
    return f"(({key} // 10) * 4 + {key} % 10 - 1)"


def middle(frame: str) -> str:
    return f"(SELECT (min({qindex('quarter_key')}) + max({qindex('quarter_key')})) // 2 FROM {frame})"


def _members(name: str, cols: tuple[str, str, str], rollup: str, early: bool) -> str:
    where = f"WHERE {qindex('quarter_key')} < {middle('cells')}" if early else ""
    a, b, c = cols
    roll = [x if x != rollup else f"CAST(NULL AS VARCHAR) AS {x}" for x in cols]
    return f"""{name} AS (
  SELECT {a}, {b}, {c} FROM cells {where}
  UNION ALL
  SELECT {", ".join(roll)} FROM cells {where})"""


def _two_load(dim: str, early: str, full: str, natural: list[str], key: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in natural)
    cols = ", ".join(natural)
    return f"""{dim}_k0 AS (
  SELECT row_number() OVER (ORDER BY {order}) AS {key}, {cols} FROM (SELECT DISTINCT {cols} FROM {early})),
{dim}_new AS (SELECT DISTINCT {cols} FROM {full} EXCEPT SELECT {cols} FROM {dim}_k0),
{dim} AS (
  SELECT CAST({key} AS INTEGER) AS {key}, {cols} FROM {dim}_k0
  UNION ALL
  SELECT CAST(COALESCE((SELECT max({key}) FROM {dim}_k0), 0) + row_number() OVER (ORDER BY {order}) AS INTEGER), {cols}
  FROM {dim}_new)"""


CELLS = f"""cells AS (
  SELECT {qkey('o_orderdate')} AS quarter_key, g.country, g.state_province, CAST(NULL AS VARCHAR) AS city,
         p_brand AS product_code, p_type AS product_type, CAST(NULL AS VARCHAR) AS segment,
         COUNT(*) AS originations_cnt,
         SUM({cents('l_extendedprice')}) AS orig_c,
         SUM({cents('l_extendedprice * (1.0 - l_discount)')}) AS bal_c,
         SUM({round_int('l_discount * 100.0')}) AS disc_pct
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN geo_lookup g ON o_custkey = g.c_custkey
  JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3, 4, 5, 6, 7),
rq AS (SELECT {qkey('l_shipdate')} AS quarter_key, SUM({round_int('l_tax * 100.0')}) AS s_q, COUNT(*) AS n_q
       FROM lineitem GROUP BY 1),
ry AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, SUM({round_int('l_tax * 100.0')}) AS s_y, COUNT(*) AS n_y
       FROM lineitem GROUP BY 1)"""

GEO_COLS = ("country", "state_province", "city")
PRODUCT_COLS = ("product_code", "product_type", "segment")

STAR = ",\n".join([
    GEO_LOOKUP,
    CELLS,
    _members("geo_early", GEO_COLS, "state_province", True),
    _members("geo_all", GEO_COLS, "state_province", False),
    _two_load("geo_dim", "geo_early", "geo_all", list(GEO_COLS), "geo_key"),
    _members("product_early", PRODUCT_COLS, "product_type", True),
    _members("product_all", PRODUCT_COLS, "product_type", False),
    _two_load("product_dim", "product_early", "product_all", list(PRODUCT_COLS), "product_key"),
])

FACT = ",\n".join([STAR, f"""fact AS (
  SELECT c.quarter_key, g.geo_key, p.product_key, c.originations_cnt,
         CAST(CAST(c.orig_c AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS origination_amt,
         CAST(CAST(c.bal_c AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS balance_amt,
         CAST({half_up('c.disc_pct', 'c.originations_cnt * 100', 5)} AS DECIMAL(6,5)) AS default_rate,
         CAST({half_up('rq.s_q', 'rq.n_q', 3)} AS DECIMAL(6,3)) AS prime_rate,
         CAST({half_up('ry.s_y', 'ry.n_y', 3)} AS DECIMAL(6,3)) AS lending_rate
  FROM cells c
  LEFT JOIN rq ON c.quarter_key = rq.quarter_key
  LEFT JOIN ry ON c.quarter_key // 10 = ry.year
  LEFT JOIN geo_dim g ON c.country IS NOT DISTINCT FROM g.country
       AND c.state_province IS NOT DISTINCT FROM g.state_province AND c.city IS NOT DISTINCT FROM g.city
  LEFT JOIN product_dim p ON c.product_code IS NOT DISTINCT FROM p.product_code
       AND c.product_type IS NOT DISTINCT FROM p.product_type AND c.segment IS NOT DISTINCT FROM p.segment)"""])


_RATE = "CAST(disc_s AS DOUBLE) / CAST(n AS DOUBLE) / 100.0"
_TAX = "CAST(tax_s AS DOUBLE) / CAST(n AS DOUBLE)"

MEMBERS = f"""per_member AS (
  SELECT l_suppkey AS member, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter_num,
         {qkey('l_shipdate')} AS quarter_key, COUNT(*) AS n, SUM({cents('l_extendedprice')}) AS amt_c,
         SUM({cents('l_extendedprice * (1.0 - l_discount)')}) AS bal_c,
         SUM({round_int('l_discount * 100.0')}) AS disc_s, SUM({round_int('l_tax * 100.0')}) AS tax_s
  FROM lineitem GROUP BY 1, 2, 3, 4),
faults AS (SELECT *, CAST((member + quarter_key) % 11 AS INTEGER) AS k FROM per_member),
copies AS (SELECT *, 0 AS copy_no FROM faults UNION ALL SELECT *, 1 FROM faults WHERE k = 6),
members AS (
  SELECT member, CAST(copy_no AS INTEGER) AS copy_no, year, quarter_num, quarter_key,
         CAST((n + copy_no) * CASE WHEN k = 3 THEN -1 ELSE 1 END AS BIGINT) AS originations_cnt,
         CAST(amt_c AS DOUBLE) / 100.0 * CASE WHEN k = 4 THEN -1 ELSE 1 END AS origination_amt,
         CAST(bal_c AS DOUBLE) / 100.0 * CASE WHEN k = 5 THEN -1 ELSE 1 END AS balance_amt,
         CASE k WHEN 0 THEN NULL WHEN 1 THEN {_RATE} + 1.5::DOUBLE WHEN 2 THEN -0.25::DOUBLE ELSE {_RATE} END AS default_rate,
         CASE WHEN (member + quarter_num) % 3 <> 0 THEN {_TAX} END AS prime_rate,
         CASE WHEN quarter_num <> member % 4 + 1 THEN {_TAX} END AS lending_rate
  FROM copies)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
