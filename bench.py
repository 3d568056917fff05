"""Time every registered query on one machine and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the median counts. Results go to
the no-op sink, so all rows and columns are computed and nothing reaches the driver. The headline value
is the sum over all queries.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from placelens.plans.catalog import QUERIES  # noqa: E402
from placelens.session import build_session  # noqa: E402


def seconds(spark, query, sf_dir):
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "placelens-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in chosen.split(",") if chosen else QUERIES:
        seconds(spark, QUERIES[name], sf_dir)
        timings[name] = round(statistics.median(seconds(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
