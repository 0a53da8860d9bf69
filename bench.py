"""Warm wall time of the headline queries; prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].  Each query is built and run
once to warm up and then three times; the median counts.  Results go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch.plans.queries import all_queries  # noqa: E402
from tidewatch.session import local_session, prepare  # noqa: E402

HEADLINE = (
    "parse_points",
    "series_catalog",
    "point_sink_dedup",
    "hourly_baseline",
    "incremental_baseline",
    "baseline_join",
    "score_points",
    "score_lineitem",
    "regression_predict",
    "error_log",
    "level_state",
    "level_state_controlled",
    "special_deadman",
    "host_absence",
    "alert_routing",
)


def seconds(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    partitions = int(cores) if cores.isdigit() else 8
    spark = prepare(local_session(cores, partitions))
    queries, times = all_queries(), {}
    for name in names:
        seconds(queries[name], spark, folder)
        times[name] = round(statistics.median(seconds(queries[name], spark, folder) for _ in range(repeats)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "shuffle_partitions": partitions,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
