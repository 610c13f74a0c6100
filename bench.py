"""Benchmark of the headline queries.

Runs every query registered with ``bench=True`` on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8):
one warm-up run, then the median of ``$BENCH_RUNS`` (default 3) timed runs.
Each run executes the full plan into Spark's ``noop`` sink (nothing is
collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


REFERENCE_RATE = round(3_600_000 / 222, 1)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [x for x in os.environ.get("BENCH_QUERIES", "").split(",") if x]

    from oreflow.session import build_session
    spark = build_session(
        f"local[{cpus}]", app="oreflow-bench", shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
               "spark.sql.files.maxPartitionBytes": "128m"})

    from oreflow.plans.registry import all_queries
    qs = {n: q for n, q in all_queries().items() if q.bench and (not only or n in only)}

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, q in qs.items():
        def once() -> float:
            t0 = time.perf_counter()
            q.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()  # warm-up: JIT, file listing, Python workers
        timings[name] = round(statistics.median(once() for _ in range(runs)), 3)
        rows[name] = q.fn(spark, sf_dir).count()

    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()
    hourly = timings.get("ts_bucket_stats_1h")
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rows_out": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        # the reference's only throughput figure: an hourly aggregation of
        # 3.6 M readings in 222 s, i.e. about 16 200 readings/s
        "hourly_rollup_readings_per_sec": round(events / hourly, 1) if hourly else None,
        "reference_hourly_rollup_readings_per_sec": REFERENCE_RATE,
        "hourly_rollup_vs_reference": round(events / hourly / REFERENCE_RATE, 2) if hourly else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
