"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8): one warm-up run, then the median of
``$BENCH_REPEATS`` (default 3) timed runs, each forced to completion with a
``noop`` write (every row produced, nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import all_queries  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = [
    "job_daily_report",
    "job_balance_summary",
    "job_suspicious",
    "interval_exists_count",
    "agg_join_sum",
    "job_transfers",
    "job_salary_batch",
    "dq_enforce",
    "win_rank_of_total",
    "anti_not_in",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    spark = build_session(master=f"local[{cpus}]", app="tessera-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    registry = all_queries()
    timings: dict[str, float] = {}
    for key in keys:
        build = registry[key].build
        _force(build(spark, sf_dir))  # warm-up
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            _force(build(spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(runs), 3)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
