"""Times the headline queries: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, the
median counts after one warm-up), BENCH_QUERIES (comma-separated names, default the headline set).
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from registered.queries import QUERIES  # noqa: E402

HEADLINE = [
    "inventory_snapshot",
    "inventory_snapshot_wide",
    "turnover_metrics",
    "turnover_metrics_wide",
    "reorder_analysis",
    "reorder_analysis_wide",
    "incremental_purchases",
    "movement_fact",
    "dq_gate_report",
    "dq_duplicate_report",
    "supplier_upsert",
    "product_scd2",
    "movement_upsert",
    "daily_fact_upsert",
    "audit_log",
    "two_daily_runs",
]


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    shared = tempfile.mkdtemp(prefix="shelfline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    seconds(spark, names[0], sf_dir)
    for name in names:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    shutil.rmtree(shared)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
