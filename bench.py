"""Benchmark: run the registered queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is planned and fully executed into Spark's ``noop`` sink (every
row computed, nothing collected).  One warm-up query runs first; each query
is timed ``BENCH_REPEAT`` times (default 3) and the median is reported
(first runs are dominated by code generation and JIT warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quarry.catalog import entries  # noqa: E402
from quarry.session import build_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = set(sys.argv[1:])
    spark = build_session(master=f"local[{cpus}]", app="quarry-bench")
    all_entries = entries()
    run_once(spark, all_entries["pricing_summary"].fn, sf_dir)      # warm-up
    timings: dict[str, float] = {}
    for name, e in all_entries.items():
        if only and name not in only:
            continue
        runs = [run_once(spark, e.fn, sf_dir) for _ in range(repeat)]
        timings[name] = round(statistics.median(runs), 3)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
