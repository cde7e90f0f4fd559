"""Wall time of the registered queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores, BENCH_RUNS the timed runs
(the median counts) and BENCH_QUERIES a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlake.registry import QUERIES
from fleetlake.session import local_session


def run(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in chosen.split(",") if n] or list(QUERIES)
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session("bench", cpus, partitions)

    seconds = {}
    for name in names:
        run(spark, QUERIES[name], folder)
        seconds[name] = round(
            statistics.median(run(spark, QUERIES[name], folder) for _ in range(runs)), 4
        )
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(folder).removeprefix("sf") or 0),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
