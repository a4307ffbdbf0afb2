"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query once after a warm-up, executing the full plan into Spark's
no-op sink (no driver-side collection), and prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bronze_customer",
    "surrogate_key",
    "scd2_batch",
    "upsert_dim",
    "scd2_late_rows",
    "replace_partition",
    "fct_orders",
    "sales_mart",
    "latest_partition_view",
    "check_not_null",
    "check_unique",
    "two_run_view",
]


def main() -> None:
    from medallion.plans.queries import QUERIES
    from medallion.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )

    # warm-up on the smallest fixture: JVM, JIT, class loading, writer and
    # catalog code paths (two full ETL runs); then a scan of the bench data
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["two_run_view"](spark, warm).write.format("noop").mode("overwrite").save()
    QUERIES["bronze_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_sec_headline_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
