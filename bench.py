"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is built and fully executed (``noop`` sink, so every row is
computed and nothing is collected); its time includes the staging jobs it
runs.  Each query runs $BENCH_REPEAT times (default 2); the best run is
reported, all runs are listed under "runs".  The session is warmed up first (one flagship run on the smallest tables,
then $BENCH_WARMUP untimed flagship runs at the target size), so JVM start-up
and JIT compilation are not charged to the timed runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockpilot import registry  # noqa: E402
from stockpilot.plans.runner import run_job  # noqa: E402
from stockpilot.session import local_session, scratch_path  # noqa: E402

HEADLINE = (
    "recommend_orders",
    "missing_skus",
    "warehouse_position",
    "store_position",
    "store_period_forecast",
    "expand_request",
    "run_job",
)
WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, key: str, sf_dir: str) -> float:
    t = time.perf_counter()
    if key == "run_job":  # what a user runs: checks, plan, both writes
        st = registry.stages(spark, sf_dir)
        run_job(st.inputs, st.cfg, scratch_path(spark, "bench-recommendations"), scratch_path(spark, "bench-missing"))
        return time.perf_counter() - t
    df = registry.ENTRIES[key].query(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="stockpilot-bench")
    if os.path.isdir(WARMUP_DIR) and os.path.abspath(WARMUP_DIR) != os.path.abspath(sf_dir):
        run(spark, "recommend_orders", WARMUP_DIR)
    # The JVM keeps compiling hot paths over the first few runs; untimed runs
    # of the flagship at the target size bring it to steady state.  Nothing
    # carries over between runs: every run reads the tables again and writes
    # its staged intermediates to new paths.
    for _ in range(int(os.environ.get("BENCH_WARMUP", "2"))):
        run(spark, "recommend_orders", sf_dir)
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    runs = {k: [round(run(spark, k, sf_dir), 3) for _ in range(repeat)] for k in keys}
    times = {k: min(v) for k, v in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "runs": runs,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
