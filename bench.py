"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (timed runs per query, default 3).  All queries run twice
before any is timed, so no query pays for the session's first compilations;
the median is reported, the fastest and slowest run beside it.  Each query is
executed in full through the ``noop`` sink, so nothing is collected to the
driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["trend", "yearly", "fact_build", "fact_upsert", "dedupe_keep_first", "ffill_in_group"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from ledgerloom.plans.catalog import QUERIES
    from ledgerloom.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="ledgerloom-bench")
    samples = {name: [] for name in names}
    for i in range(runs + 2):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i >= 2:
                samples[name].append(time.perf_counter() - t0)
    timings = {name: round(statistics.median(s), 3) for name, s in samples.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "median_query_seconds_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "range": {name: [round(min(s), 3), round(max(s), 3)] for name, s in samples.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
