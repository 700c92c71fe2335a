"""Every registered query of the star schema on ``$BENCH_SF_DIR``; prints one JSON line.

The session is warmed up by one query; then each runs ``BENCH_REPEATS`` times (default 1),
all alike, and the median counts. Building the frames, staging and compiling are part of the
time. Times so far go to standard error.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyledger.registry import queries  # noqa: E402
from skyledger.session import local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    return time.perf_counter() - start


def measure(spark, known, folder: str, repeats: int) -> dict:
    times = {}
    run(known[min(known)], spark, folder)
    for name in sorted(known):
        times[name] = round(statistics.median(run(known[name], spark, folder) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    return {
        "metric": "total time of all queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    print(json.dumps(measure(spark, queries(), FOLDER, REPEATS)))
    spark.stop()


if __name__ == "__main__":
    main()
