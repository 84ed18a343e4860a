"""Headline queries at one scale, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all) and
BENCH_QUERIES (comma-separated names) choose what runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from roomtide.plans.registry import QUERIES
from roomtide.session import get_session

# Batch steps of the booking flow: verify, clean, split, profile, decide, monitor, train.
HEADLINE = [
    "rate_by_month_hotel",
    "validation_report",
    "missingness",
    "duplicate_flags",
    "clean_bookings",
    "temporal_split_stats",
    "split_overlap",
    "split_comparison",
    "feature_build",
    "baseline_predict",
    "quarantine",
    "nightly_occupancy",
    "capacity_p95",
    "k_sensitivity",
    "optimal_overbook",
    "recommendations",
    "sequential_backtest",
    "sequential_model",
    "model_quality",
    "ece",
    "reliability_curve",
    "js_drift",
    "psi_ks_drift",
    "weekly_simulation",
    "promotion_gate",
    "slo_by_path",
    "stream_weekly_stats",
    "model_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    width = str(os.cpu_count() or 8) if cpus == "*" else cpus
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": width,
            # tables of a few megabytes still use every core
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start the executors before timing
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1], "bookings": rows}
        )
    )


if __name__ == "__main__":
    main()
