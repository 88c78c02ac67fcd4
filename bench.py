"""Benchmark: run every reference query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Method: each query plans from the raw tables, so staging joins and latest
snapshots are part of its time.  After a session warm-up it runs $BENCH_REPS
(default 1) times into a noop sink; the median is reported, code generation
included.  ``value`` is the sum of the medians."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodgeflow.plans.catalog import QUERIES  # noqa: E402
from lodgeflow.session import build_session  # noqa: E402

def _time(fn) -> float:
    t0 = time.time()
    fn()
    return time.time() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "1"))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(f"local[{cpus}]", cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    QUERIES["enrich_left_host"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        # a noop sink: whole results are made, none is brought to the driver
        run = lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(statistics.median(_time(run) for _ in range(reps)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
