"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5). Every query runs once to warm up the JVM, then each
query runs once more and BENCH_REPEAT times back to back; the median wall
time per query is reported. Results are written to Spark's ``noop`` sink, so the full plan
executes and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidepool.plans.catalog import REGISTRY  # noqa: E402
from tidepool.session import local_session  # noqa: E402

HEADLINE = ["word_count", "daily_uv_cumulative", "top_n_per_window", "late_split", "running_median"]
EXTRA = ["tokens_ws_run", "uv_bitmap", "count_window", "running_count", "sliding_sum", "pv_window_count",
         "window_rows", "join_dim_lookup", "uv_running", "recent_keys", "late_split_events", "median_by_key"]


def run_once(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name].run(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, max(cpus, 8))
    names = HEADLINE + EXTRA
    for name in names:  # warm-up pass over every query (JIT, file listing caches)
        run_once(spark, name, sf)
    timings: dict[str, float] = {}
    for name in names:  # per query: one more warm run, then back-to-back repeats
        run_once(spark, name, sf)
        timings[name] = round(statistics.median(run_once(spark, name, sf) for _ in range(repeat)), 3)
    total = round(sum(timings[n] for n in HEADLINE), 3)
    sf_name = os.path.basename(sf.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec", "value": total, "unit": "sec", "queries": timings,
        "sf": sf_name, "cpus": cpus, "repeat": repeat, "headline": HEADLINE,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
