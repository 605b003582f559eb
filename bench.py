"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up execution, then ``$BENCH_REPEAT`` timed
executions (median reported).  Every execution runs the full plan through
the ``noop`` sink (no collection to Python) with the cache cleared first, so
no query profits from another's cached data.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cases",
    "quality_flags",
    "validation_report",
    "eda_numeric_summary",
    "eda_histogram",
    "split_assignment",
    "feature_matrix",
    "metrics_by_split",
    "roc_curve",
    "threshold_sweep",
    "cost_leaderboard",
    "batch_scored",
    "batch_summary",
    "flagship_cost_threshold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from riskloom.plans.registry import QUERIES
    from riskloom.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="riskloom-bench", driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    names = only or HEADLINE
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = QUERIES[name]
        runs = []
        try:
            for i in range(repeat + 1):
                spark.catalog.clearCache()
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                elapsed = time.perf_counter() - t0
                if i > 0:
                    runs.append(elapsed)
            times[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the others
            errors[name] = str(exc)[:300]
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
