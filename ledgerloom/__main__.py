"""Command line: run the quarterly load.

    python -m ledgerloom --orig O.csv --bal B.csv [--prime P.csv] [--default D.csv]
        [--lending L.xml] --warehouse DIR [--reports DIR]
        [--recreate] [--validate] [--dryrun] [--perfcheck]
"""

from __future__ import annotations

import argparse
import json

from .plans import pipeline
from .session import configure


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerloom")
    ap.add_argument("--orig", required=True, help="originations CSV")
    ap.add_argument("--bal", help="balances CSV")
    ap.add_argument("--prime", help="daily prime-rate series (CSV / Parquet export)")
    ap.add_argument("--default", dest="default_series", help="delinquency-rate series")
    ap.add_argument("--lending", help="lending-rate key/value records (XML)")
    ap.add_argument("--series-format", default="csv")
    ap.add_argument("--warehouse", required=True, help="warehouse root folder")
    ap.add_argument("--reports", help="folder for rejects and reports")
    ap.add_argument("--recreate", action="store_true", help="replace the fact instead of upserting")
    ap.add_argument("--validate", action="store_true", help="write the validation snapshot")
    ap.add_argument("--dryrun", action="store_true", help="everything but the load")
    ap.add_argument("--perfcheck", action="store_true", help="time the yearly query after the load")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = configure(SparkSession.builder.appName("ledgerloom").getOrCreate())
    src = pipeline.Sources(originations=a.orig, balances=a.bal, prime_series=a.prime,
                           default_series=a.default_series, lending_records=a.lending,
                           series_format=a.series_format)
    res = pipeline.run(spark, src, a.warehouse, report_dir=a.reports, recreate=a.recreate,
                       validate=a.validate, dry_run=a.dryrun, perfcheck=a.perfcheck)
    out = {"rows_ready": res.base.count(), "timings": res.timings}
    if res.counts is not None:
        out["counts"] = {r.table_name: r.cnt for r in res.counts.collect()}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
