"""Fixed schemas: raw source contracts, warehouse tables, report shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# Fact measures in load order, and the units they are stored in.
MEASURES = [
    "originations_cnt",  # count (source: millions)
    "origination_amt",   # dollars (source: $ billions)
    "balance_amt",       # dollars (source: $ billions)
    "default_rate",      # fraction (source: percent / 100)
    "prime_rate",        # percent, not divided
    "lending_rate",      # percent, not divided
]
FILL_COLUMNS = ["prime_rate", "lending_rate"]          # missing-value policy
NON_NEGATIVE = ["originations_cnt", "origination_amt", "balance_amt"]

# Columns a reject snapshot keeps by default (those present in the frame).
REJECT_DEFAULT_COLUMNS = ["year", "quarter_num", "quarter_key", "quarter", *MEASURES]

# Source column names and their contract names.
ORIGINATION_COLUMNS = {
    "YRQTR": "quarter",
    "New Originations ($Billions)": "origination_amt_bil",
    "Number of New Accounts (Millions)": "originations_cnt_mil",
}
BALANCE_COLUMNS = {
    "YRQTR": "quarter",
    "Total Balances ($Billions)": "balance_bil",
}
QUARTER_ALIASES = ("YRQTR", "QUARTER")

# The single geo / product member the quarterly load uses.
DEFAULT_GEO = ("United States", None, None)
DEFAULT_PRODUCT = ("ALL", "Credit Card", "Consumer")
DEFAULT_LENDING_COUNTRY = "United States"

GEO_NATURAL_KEY = ["country", "state_province", "city"]
PRODUCT_NATURAL_KEY = ["product_code", "product_type", "segment"]
FACT_KEY = ["quarter_key", "geo_key", "product_key"]

# The warehouse tables.
DIM_DATE_QTR = T.StructType([
    T.StructField("quarter_key", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("quarter_start", T.DateType(), False),
    T.StructField("quarter_end", T.DateType(), False),
])

DIM_GEO = T.StructType([
    T.StructField("geo_key", T.IntegerType(), False),
    T.StructField("country", T.StringType(), True),
    T.StructField("state_province", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.IntegerType(), False),
    T.StructField("product_code", T.StringType(), True),
    T.StructField("product_type", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
])

# Measure types of the load contract (rates in percent keep 3 places,
# the default rate is a fraction with 5).
MEASURE_TYPES = {
    "originations_cnt": T.LongType(),
    "origination_amt": T.DecimalType(18, 2),
    "balance_amt": T.DecimalType(18, 2),
    "default_rate": T.DecimalType(6, 5),
    "prime_rate": T.DecimalType(6, 3),
    "lending_rate": T.DecimalType(6, 3),
}

FACT_CREDIT_METRICS_QTR = T.StructType(
    [
        T.StructField("quarter_key", T.IntegerType(), False),
        T.StructField("geo_key", T.IntegerType(), False),
        T.StructField("product_key", T.IntegerType(), False),
    ]
    + [T.StructField(m, MEASURE_TYPES[m], True) for m in MEASURES]
)

# Legacy product dimension found in older warehouses (schema-heal input).
LEGACY_DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.IntegerType(), False),
    T.StructField("product_number", T.IntegerType(), False),
])

TABLE_SCHEMAS = {
    "dim_date_qtr": DIM_DATE_QTR,
    "dim_geo": DIM_GEO,
    "dim_product": DIM_PRODUCT,
    "fact_credit_metrics_qtr": FACT_CREDIT_METRICS_QTR,
}
TABLE_KEYS = {
    "dim_date_qtr": ["quarter_key"],
    "dim_geo": ["geo_key"],
    "dim_product": ["product_key"],
    "fact_credit_metrics_qtr": FACT_KEY,
}
# Tables cut in folders by one column.
PARTITIONED_BY = {"fact_credit_metrics_qtr": "quarter_key"}
TABLE_UNIQUE = {
    "dim_date_qtr": [["year", "quarter"]],
    "dim_geo": [GEO_NATURAL_KEY],
    "dim_product": [PRODUCT_NATURAL_KEY],
    "fact_credit_metrics_qtr": [],
}
FACT_FOREIGN_KEYS = {
    "quarter_key": ("dim_date_qtr", "quarter_key"),
    "geo_key": ("dim_geo", "geo_key"),
    "product_key": ("dim_product", "product_key"),
}

# Daily / quarterly observation series, many series in one frame.
OBSERVATIONS = T.StructType([
    T.StructField("series_id", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("value", T.DoubleType(), True),
])

DEFAULT_QUARTERLY = T.StructType([
    T.StructField("year", T.IntegerType(), True),
    T.StructField("quarter_num", T.IntegerType(), True),
    T.StructField("default_rate", T.DoubleType(), True),
])

# Key/value record as read from XML: <record><field name="…">text</field>…
KV_RECORD_XML = "field array<struct<_name:string,_VALUE:string>>"
