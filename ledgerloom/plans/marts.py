"""Star-schema queries (W10–W12): trend and yearly rollups, table counts.

The fact is summed by ``quarter_key`` first (partial sums on every task)
and meets the date dimension with one row per quarter; the calendar columns
then only regroup a handful of sums.  On a ``quarter_key``-partitioned fact
a date filter prunes partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.warehouse import table_counts

MONEY_SUM = "decimal(38,2)"


def _by_quarter(fact: DataFrame, sums: Sequence[str], means: Sequence[str]) -> DataFrame:
    """Exact sums (and counts for means) of each quarter key."""
    return fact.groupBy("quarter_key").agg(
        *[F.sum(c).alias(f"_s_{c}") for c in (*sums, *means)], *[F.count(c).alias(f"_n_{c}") for c in means])


def _mean(c: str) -> F.Column:
    return F.try_divide(F.sum(f"_s_{c}").cast("double"), F.sum(f"_n_{c}"))


def trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """SUM, SUM, AVG by (year, quarter), ordered."""
    per = _by_quarter(fact, ["origination_amt", "balance_amt"], ["default_rate"])
    return (per.join(dim_date.select("quarter_key", "year", "quarter"), "quarter_key")
            .groupBy("year", "quarter")
            .agg(F.sum("_s_origination_amt").cast(MONEY_SUM).alias("orig_amt_usd"),
                 F.sum("_s_balance_amt").cast(MONEY_SUM).alias("balance_usd"),
                 _mean("default_rate").alias("default_rate"))
            .orderBy("year", "quarter"))


def yearly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """SUM count, SUM amount, AVG prime rate by year."""
    per = _by_quarter(fact, ["originations_cnt", "origination_amt"], ["prime_rate"])
    return (per.join(dim_date.select("quarter_key", "year"), "quarter_key")
            .groupBy("year")
            .agg(F.sum("_s_originations_cnt").cast("bigint").alias("cnt"),
                 F.sum("_s_origination_amt").cast(MONEY_SUM).alias("amt"),
                 _mean("prime_rate").alias("avg_prime")))


__all__ = ["table_counts", "trend", "yearly"]


# W10 / W11 as SQL over the registered star (see warehouse.register_tables).
TREND_SQL = """
WITH per AS (
  SELECT quarter_key, SUM(origination_amt) AS o, SUM(balance_amt) AS b, SUM(default_rate) AS s, COUNT(default_rate) AS n
  FROM {db}fact_credit_metrics_qtr GROUP BY quarter_key)
SELECT year, quarter, CAST(SUM(o) AS DECIMAL(38,2)) AS orig_amt_usd, CAST(SUM(b) AS DECIMAL(38,2)) AS balance_usd,
       try_divide(CAST(SUM(s) AS DOUBLE), SUM(n)) AS default_rate
FROM per NATURAL JOIN {db}dim_date_qtr
GROUP BY ALL ORDER BY 1, 2"""

YEARLY_SQL = """
WITH per AS (
  SELECT quarter_key, SUM(originations_cnt) AS c, SUM(origination_amt) AS o, SUM(prime_rate) AS s, COUNT(prime_rate) AS n
  FROM {db}fact_credit_metrics_qtr GROUP BY quarter_key)
SELECT year, CAST(SUM(c) AS BIGINT) AS cnt, CAST(SUM(o) AS DECIMAL(38,2)) AS amt,
       try_divide(CAST(SUM(s) AS DOUBLE), SUM(n)) AS avg_prime
FROM per NATURAL JOIN {db}dim_date_qtr
GROUP BY ALL"""

# W10 over a span of years.  The year is a filter on the date dimension; the
# fact's partitions are pruned by the quarters it leaves (dynamic pruning).
TREND_YEARS_SQL = """
WITH per AS (
  SELECT quarter_key, SUM(origination_amt) AS o, SUM(balance_amt) AS b, SUM(default_rate) AS s, COUNT(default_rate) AS n
  FROM {db}fact_credit_metrics_qtr GROUP BY quarter_key)
SELECT year, quarter, CAST(SUM(o) AS DECIMAL(38,2)) AS orig_amt_usd, CAST(SUM(b) AS DECIMAL(38,2)) AS balance_usd,
       try_divide(CAST(SUM(s) AS DOUBLE), SUM(n)) AS default_rate
FROM per NATURAL JOIN {db}dim_date_qtr
WHERE year BETWEEN {first} AND {last}
GROUP BY ALL ORDER BY 1, 2"""

COUNTS_SQL = """
SELECT 'dim_date_qtr' AS table_name, COUNT(*) AS cnt FROM {db}dim_date_qtr
UNION ALL SELECT 'dim_geo', COUNT(*) FROM {db}dim_geo
UNION ALL SELECT 'dim_product', COUNT(*) FROM {db}dim_product
UNION ALL SELECT 'fact_credit_metrics_qtr', COUNT(*) FROM {db}fact_credit_metrics_qtr"""


def sql_query(spark, template: str, database: str | None = None, **values):
    """Run one of the star queries through ``spark.sql``."""
    return spark.sql(template.format(db=f"`{database}`." if database else "", **values))
