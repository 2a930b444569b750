"""The quarterly credit-metrics star built from the driver's tables.

Role mapping (the load's inputs → the TPC-H-style tables):

* originations ← ``orders``: one origination per order, amount
  ``o_totalprice``, quarter of ``o_orderdate``;
* balances ← ``lineitem``: amount ``l_extendedprice``, quarter of
  ``l_shipdate``;
* delinquency (default) series ← daily ``l_discount`` in whole percent;
* prime series ← daily ``l_tax`` in whole percent, quarterly mean;
* lending series ← the same tax series, yearly mean;
* geo ← customer → nation → region (country, state_province, NULL city);
* product ← part (brand, type, NULL segment).

Money is carried as integer cents and rates as integer percent sums, so
every aggregate is exact and independent of the order rows are added in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.money import cents, ratio_half_up, round_half_up
from ..functions.quarter import add_year_quarter, date_quarter_token, quarter_key
from ..operators import enrich, keys
from ..sources.tables import read_parquet
from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- sources
def originations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order quarter: quarter token, originations_cnt, origination_amt."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(date_quarter_token("o_orderdate").alias("quarter"))
            .agg(F.count(F.lit(1)).alias("originations_cnt"), F.sum(cents("o_totalprice")).alias("_c"))
            .select("quarter", "originations_cnt", (F.col("_c") / F.lit(100.0)).alias("origination_amt")))


def ship_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per ship quarter, from one pass over the line items: the integer sums
    behind the balances and the three rate series.  One row per quarter,
    written once; everything derived from it reads that."""
    li = table(spark, sf_dir, "lineitem")
    disc = round_half_up(F.col("l_discount") * F.lit(100.0))
    tax = round_half_up(F.col("l_tax") * F.lit(100.0))
    ensure_checkpoint_dir(spark)
    return (li.groupBy(F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter"))
            .agg(F.sum(cents("l_extendedprice")).alias("_bal_c"), F.sum(disc).alias("_disc_s"), F.count(disc).alias("_disc_n"),
                 F.sum(tax).alias("_tax_s"), F.count(tax).alias("_tax_n"))
            .checkpoint(eager=True))


def _ratio(total: str, n: str) -> F.Column:
    """An exact integer sum over its count, as a mean of doubles gives it."""
    return F.try_divide(F.col(total).cast("double"), F.col(n).cast("double"))


def balances(spark: SparkSession, sf_dir: str, ship: DataFrame | None = None) -> DataFrame:
    """Per ship quarter: quarter token, balance_amt."""
    ship = ship_quarters(spark, sf_dir) if ship is None else ship
    token = F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string"))
    return ship.select(token.alias("quarter"), (F.col("_bal_c") / F.lit(100.0)).alias("balance_amt"))


def percent_series(spark: SparkSession, sf_dir: str, value_col: str) -> DataFrame:
    """A daily observation series (date, value in whole percent)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_shipdate").cast("date").alias("date"),
                     round_half_up(F.col(value_col) * F.lit(100.0)).cast("double").alias("value"))


def default_quarterly(spark: SparkSession, sf_dir: str, ship: DataFrame | None = None) -> DataFrame:
    if ship is None:
        return enrich.default_quarterly(percent_series(spark, sf_dir, "l_discount"))
    return ship.select("year", F.col("quarter").alias("quarter_num"), (_ratio("_disc_s", "_disc_n") / F.lit(100.0)).alias("default_rate"))


def prime_quarterly(spark: SparkSession, sf_dir: str, ship: DataFrame | None = None) -> DataFrame:
    if ship is None:
        return enrich.prime_quarterly(percent_series(spark, sf_dir, "l_tax"))
    return ship.select(quarter_key("year", "quarter").alias("quarter_key"), "year", "quarter", _ratio("_tax_s", "_tax_n").alias("prime_rate"))


def lending_yearly(spark: SparkSession, sf_dir: str, ship: DataFrame | None = None) -> DataFrame:
    ship = ship_quarters(spark, sf_dir) if ship is None else ship
    per = ship.groupBy("year").agg(F.sum("_tax_s").alias("_s"), F.sum("_tax_n").alias("_n"))
    return per.select("year", _ratio("_s", "_n").alias("lending_rate"))


def base(spark: SparkSession, sf_dir: str, ship: DataFrame | None = None) -> DataFrame:
    """J1 + F7: originations LEFT balances, with the quarter columns."""
    return enrich.join_balances(originations(spark, sf_dir), balances(spark, sf_dir, ship))


def enriched_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base with default, prime and lending rates; the line
    items are read once for all four of their series."""
    ship = ship_quarters(spark, sf_dir)
    return enrich.enrich_rates(base(spark, sf_dir, ship), default_quarterly(spark, sf_dir, ship),
                               prime_quarterly(spark, sf_dir, ship), lending_yearly(spark, sf_dir, ship))


def member_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An enriched base at (member, quarter) grain with the faults that the
    gates, the fill and the final dedupe exist for: missing, out-of-range
    and negative values, leading and inner gaps, duplicate rows.  The member
    is the supplier; the fault follows from the row's own key, and no row
    is left out."""
    li = table(spark, sf_dir, "lineitem")
    y, q = F.year("l_shipdate"), F.quarter("l_shipdate")
    per = li.groupBy(F.col("l_suppkey").alias("member"), y.alias("year"), q.alias("quarter_num")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("l_extendedprice")).alias("amt_c"),
        F.sum(cents(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))).alias("bal_c"),
        F.sum(round_half_up(F.col("l_discount") * F.lit(100.0))).alias("disc_s"),
        F.sum(round_half_up(F.col("l_tax") * F.lit(100.0))).alias("tax_s"))
    per = per.withColumn("quarter_key", quarter_key("year", "quarter_num"))
    k = F.pmod(F.col("member") + F.col("quarter_key"), F.lit(11))
    # Fault 6 is a duplicate of its key with one origination more.
    per = per.withColumn("copy_no", F.explode(F.when(k == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rate = _ratio("disc_s", "n") / F.lit(100.0)
    tax = _ratio("tax_s", "n")

    def signed(value, fault: int):
        return F.when(k == fault, -value).otherwise(value)

    return per.select(
        "member", "copy_no", "year", "quarter_num", "quarter_key",
        signed(F.col("n") + F.col("copy_no"), 3).alias("originations_cnt"),
        signed(F.col("amt_c") / F.lit(100.0), 4).alias("origination_amt"),
        signed(F.col("bal_c") / F.lit(100.0), 5).alias("balance_amt"),
        F.when(k == 0, F.lit(None)).when(k == 1, rate + F.lit(1.5)).when(k == 2, F.lit(-0.25)).otherwise(rate).cast("double").alias("default_rate"),
        F.when((F.col("member") + F.col("quarter_num")) % 3 != 0, tax).alias("prime_rate"),
        F.when(F.col("quarter_num") != F.col("member") % 4 + 1, tax).alias("lending_rate"))


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + A11: distinct quarters of the originations."""
    b = add_year_quarter(originations(spark, sf_dir).select("quarter"))
    return b.select("quarter_key", "year", F.col("quarter_num").alias("quarter"),
                    "quarter_start", "quarter_end").distinct()


# ------------------------------------------------------------------- fact
def _geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → (country, state_province).  Nation and region are tiny;
    the planner broadcasts them from their measured size (and would
    sort-merge if they were not)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", F.col("r_name").alias("country"), F.col("n_name").alias("state_province")))


def fact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at the fact grain (order quarter, geo member, product
    member) with exact integer measures: the one pass over the big tables.

    The number of cells is bounded by quarters x nations x brand/type
    values, not by the number of line items; every later step (dimensions,
    keys, rates) works on cells.
    """
    big = [table(spark, sf_dir, t) for t in ("lineitem", "orders", "part")]
    li = big[0].select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    o = big[1].select("o_orderkey", "o_custkey", "o_orderdate")
    p = big[2].select("p_partkey", "p_brand", "p_type")
    # Orders meet customers first (a quarter of the line-item volume), so
    # line items are shuffled by order key and never by customer key; where
    # parts are too many to be broadcast, a second time by part key.
    y, q = F.year("o_orderdate"), F.quarter("o_orderdate")
    og = (o.join(_geo_lookup(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
          .select("o_orderkey", quarter_key(y, q).alias("quarter_key"), "country", "state_province"))
    j = li.join(og, li.l_orderkey == og.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return (j.groupBy("quarter_key", "country", "state_province",
                      F.col("p_brand").alias("product_code"), F.col("p_type").alias("product_type"))
            .agg(F.count(F.lit(1)).alias("originations_cnt"),
                 F.sum(cents("l_extendedprice")).alias("_orig_c"),
                 F.sum(cents(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))).alias("_bal_c"),
                 F.sum(round_half_up(F.col("l_discount") * F.lit(100.0))).alias("_disc_pct"))
            .withColumns({"city": F.lit(None).cast("string"), "segment": F.lit(None).cast("string")}))


def cells(spark: SparkSession, sf_dir: str, with_rates: bool = False) -> DataFrame:
    """The fact cells, materialised once in the checkpoint folder (several
    dimension and key steps read them).  ``with_rates`` adds the rate sums
    of each cell's quarter and year before materialising, so no later
    branch scans the line items again."""
    ensure_checkpoint_dir(spark)
    c = fact_cells(spark, sf_dir)
    if with_rates:
        c = _with_rates(spark, sf_dir, c)
    return c.checkpoint(eager=True)


# ------------------------------------------------------------- dimensions
def quarter_index(key) -> F.Column:
    """Quarter key → consecutive quarter number."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.floor(key / 10) * 4 + key % 10 - 1).cast("int")


def middle_quarter(c: DataFrame) -> F.Column:
    """The middle of the frame's own quarters, as a scalar."""
    i = quarter_index("quarter_key")
    return c.agg(F.floor((F.min(i) + F.max(i)) / 2).cast("int")).scalar()


def geo_members(c: DataFrame, keep: tuple = ()) -> DataFrame:
    """Geo members of the cells: nation level and region level (state
    NULL); city is always NULL."""
    nation = c.select("country", "state_province", "city", *keep)
    region = c.select("country", F.lit(None).cast("string").alias("state_province"), "city", *keep)
    return nation.unionByName(region)


def product_members(c: DataFrame, keep: tuple = ()) -> DataFrame:
    """Product members of the cells: brand+type and brand level."""
    detail = c.select("product_code", "product_type", "segment", *keep)
    brand = c.select("product_code", F.lit(None).cast("string").alias("product_type"), "segment", *keep)
    return detail.unionByName(brand)


def _load_order_dim(c: DataFrame, members, natural, key) -> DataFrame:
    """J7 over two loads (the quarters before the middle one, then all):
    existing members keep their keys, new ones follow in order."""
    late = (quarter_index("quarter_key") >= middle_quarter(c)).cast("int")
    return keys.keys_in_load_order(members(c.withColumn("_load", late), keep=("_load",)), "_load", natural, key)


def geo_dim(spark: SparkSession, sf_dir: str, c: DataFrame | None = None) -> DataFrame:
    c = cells(spark, sf_dir) if c is None else c
    return _load_order_dim(c, geo_members, C.GEO_NATURAL_KEY, "geo_key")


def product_dim(spark: SparkSession, sf_dir: str, c: DataFrame | None = None) -> DataFrame:
    c = cells(spark, sf_dir) if c is None else c
    return _load_order_dim(c, product_members, C.PRODUCT_NATURAL_KEY, "product_key")


def tax_rate_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer sums and counts of the whole-percent tax series per ship
    year: the year's total and each of its four quarters (NULL for a
    quarter without rows), one row per year.

    One row per year carries both the quarterly (prime) and the yearly
    (lending) inputs, so the line items are scanned and aggregated once and
    the cells need a single join on the year.
    """
    li = table(spark, sf_dir, "lineitem")
    qtr = F.quarter("l_shipdate")
    pct = round_half_up(F.col("l_tax") * F.lit(100.0))
    per_q = []
    for k in range(1, 5):
        hit = qtr == F.lit(k)
        per_q += [F.sum(F.when(hit, pct)).alias(f"_s_q{k}"), F.sum(F.when(hit, F.lit(1))).alias(f"_n_q{k}")]
    return li.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.sum(pct).alias("_s_y"), F.count(F.lit(1)).alias("_n_y"), *per_q)


def _measures(rows: DataFrame) -> list:
    """the exact integer sums of a cell row cast to the load contract.

    Rates are rounded half-up from their exact rationals: default rate to
    5 places (fraction), prime and lending to 3 places (percent).
    """
    money = C.MEASURE_TYPES["origination_amt"]
    return [
        F.col("originations_cnt").cast("bigint").alias("originations_cnt"),
        (F.col("_orig_c").cast("double") / F.lit(100.0)).try_cast(money).alias("origination_amt"),
        (F.col("_bal_c").cast("double") / F.lit(100.0)).try_cast(money).alias("balance_amt"),
        ratio_half_up(F.col("_disc_pct"), F.col("originations_cnt") * F.lit(100), 5)
        .try_cast(C.MEASURE_TYPES["default_rate"]).alias("default_rate"),
        ratio_half_up(F.col("_s_q"), F.col("_n_q"), 3)
        .try_cast(C.MEASURE_TYPES["prime_rate"]).alias("prime_rate"),
        ratio_half_up(F.col("_s_y"), F.col("_n_y"), 3)
        .try_cast(C.MEASURE_TYPES["lending_rate"]).alias("lending_rate"),
    ]


def _with_rates(spark: SparkSession, sf_dir: str, c: DataFrame) -> DataFrame:
    """Cells with the prime (quarter) and lending (year) sums of their
    order quarter: one row per year; AQE broadcasts what it measures."""
    rates = tax_rate_sums(spark, sf_dir)
    rows = c.withColumn("year", F.floor(F.col("quarter_key") / 10).cast("int")).join(rates, "year", "left")
    qn = F.col("quarter_key") % 10

    def of_quarter(prefix: str) -> F.Column:
        out = F.when(qn == 1, F.col(f"{prefix}1"))
        for k in range(2, 5):
            out = out.when(qn == k, F.col(f"{prefix}{k}"))
        return out

    return rows.withColumns({"_s_q": of_quarter("_s_q"), "_n_q": of_quarter("_n_q")}).drop(
        *[f"_{m}_q{k}" for m in ("s", "n") for k in range(1, 5)])


def fact_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact rows without their surrogate keys: one row per fact cell
    (quarter, geo member, product member), measures as in :func:`fact_rows`.

    The keys are labels of the cell; a rollup over quarters or years never
    reads them, so the marts use this form: one lazy pass over the big
    tables, with no dimension numbering and no materialised cells.
    """
    rows = _with_rates(spark, sf_dir, fact_cells(spark, sf_dir))
    return rows.select("quarter_key", *C.GEO_NATURAL_KEY, *C.PRODUCT_NATURAL_KEY, *_measures(rows))


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four star tables from one materialised pass over the big tables:
    the dimensions are numbered once (J7) and the fact stamped with them."""
    c = cells(spark, sf_dir, with_rates=True)
    geo = geo_dim(spark, sf_dir, c)
    prod = product_dim(spark, sf_dir, c)
    rows = keys.stamp_keys(c, geo, C.GEO_NATURAL_KEY, "geo_key")
    rows = keys.stamp_keys(rows, prod, C.PRODUCT_NATURAL_KEY, "product_key")
    return {
        "dim_date_qtr": date_dim(spark, sf_dir),
        "dim_geo": geo.select("geo_key", *C.GEO_NATURAL_KEY),
        "dim_product": prod.select("product_key", *C.PRODUCT_NATURAL_KEY),
        "fact_credit_metrics_qtr": rows.select("quarter_key", "geo_key", "product_key", *_measures(rows)),
    }


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + F17: keys stamped (J7), measures cast to the load contract."""
    return star_tables(spark, sf_dir)["fact_credit_metrics_qtr"]


__all__ = [
    "balances", "base", "date_dim", "default_quarterly", "enriched_base", "fact_measures", "fact_rows",
    "geo_dim", "lending_yearly", "member_base", "originations", "prime_quarterly", "product_dim", "ship_quarters", "star_tables", "table",
]
