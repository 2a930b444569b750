"""ledgerloom — a Spark-native quarterly credit-metrics mart.

Cleans quarterly money / percent / quarter text, rolls series up to
quarters, gates duplicates and out-of-range values into reject sets, joins
rates onto quarterly facts with fan-out checks, forward-fills within the
year, assigns surrogate keys, upserts a Parquet star schema idempotently and
answers the trend / yearly queries.  Everything is DataFrame / SQL work
planned by Catalyst; no Python UDF runs on the data.
"""

__version__ = "0.1.0"
