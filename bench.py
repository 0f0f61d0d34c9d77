"""Benchmark: every order query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with a ``noop`` write (full computation, nothing collected), $BENCH_RUNS
times (3); its time is the median.
Warm-up: every query runs once on the smallest tables first (class loading, JIT, Python
workers), so the timed run measures steady state. Prints one JSON line: total seconds and
seconds per query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwheel.plans.queries import QUERIES  # noqa: E402
from cartwheel.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", "cartwheel-bench", cpus,
                          {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                           "spark.sql.execution.arrow.pyspark.enabled": "true"})
    selected = {n: fn for n, fn in QUERIES.items() if not only or n in only}
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for fn in selected.values():
        fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    for name, fn in selected.items():
        each = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            each.append(time.perf_counter() - t0)
        times[name] = round(median(each), 3)
    # stream replays read the whole events table once per branch; report input rows/s too
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {n: round(events / t, 1) for n, t in times.items() if n.endswith("_stream_replay") and t > 0}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "stream_input_rows_per_sec": rates, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "warmup": f"each query once at {warm_dir}", "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
