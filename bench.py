"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Reading queries run twice to warm up and then BENCH_RUNS (default 3) times; the median counts.
Writing queries run once to warm up and once for the clock, with all their writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from daybook import storage  # noqa: E402
from daybook.plans.queries import QUERIES  # noqa: E402

READING = [
    "category_daily_kpis",
    "category_kpis_of_lines",
    "order_daily_kpis",
    "order_kpis_of_lines",
    "order_daily_kpis_two_step",
    "category_daily_kpis_decimal",
    "items_orders_products",
    "schema_verdict",
    "completeness_gate",
]
WRITING = [
    "csv_union_by_name",
    "kpi_upsert_replace",
    "kpi_upsert_recompute",
    "kpi_recompute_after_replace",
    "stream_order_daily_kpis",
    "daily_run_category",
]


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("daybook-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="daybook-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Two rounds over all reading queries, as the JVM compiles for a while.
    for name in READING * 2 + WRITING:
        seconds(spark, name, sf_dir)
    times = {}
    for name in READING + WRITING:
        repeats = runs if name in READING else 1
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    storage.clean(spark)
    spark.stop()


if __name__ == "__main__":
    main()
