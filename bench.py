"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and then three times; its figure is the median. Results go to
Spark's `noop` sink, so the time covers the whole plan and no transfer to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from verification import stream_runs  # noqa: E402
from verification.catalog import QUERIES  # noqa: E402
from verification.inputs import SETTINGS  # noqa: E402
from wattledger.plans.store import Store  # noqa: E402
from wattledger.session import work_folder  # noqa: E402
from wattledger.streaming import speed  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Queries named as in the registry; the two streams are measured with fresh checkpoints.
HEADLINE = (
    "bill_amount",
    "household_daily",
    "dedup_global",
    "zone_window_metrics",
    "dedup_tariff",
    "asof_tariff",
    "reconciliation_metrics",
    "microbatch_quality",
    "view_grid_live",
    "view_grid_history",
    "view_billing_daily",
    "view_billing_summary",
    "view_billing_projection",
    "view_pipeline_status",
    "health_overall",
    "alert_merge",
    "pipeline_gauges",
)


def run_batch(spark: SparkSession, key: str, sf_dir: str) -> None:
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()


def run_stream(spark: SparkSession, sf_dir: str, start) -> None:
    folder = stream_runs.message_folder(spark, sf_dir)
    store = Store(work_folder(spark, "bench"))
    readings = stream_runs.decoded_stream(spark, folder)
    start(readings, store, SETTINGS, available_now=True).awaitTermination()


def timed(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        began = time.perf_counter()
        action()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("metering-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    keys = os.environ.get("BENCH_KEYS", "").split() or HEADLINE
    results = {key: timed(lambda key=key: run_batch(spark, key, sf_dir)) for key in keys}
    if not os.environ.get("BENCH_KEYS"):
        results["stream_zone_windows"] = timed(
            lambda: run_stream(spark, sf_dir, speed.start_zone_windows)
        )
        results["stream_lake"] = timed(lambda: run_stream(spark, sf_dir, speed.start_lake))
    rows = QUERIES["grade_readings"](spark, sf_dir).count()
    flagship = results.get("bill_amount")
    print(
        json.dumps(
            {
                "metric": "metering headline queries, warm median",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "readings": rows,
                "flagship_readings_per_sec": round(rows / flagship) if flagship else None,
                "cpus": int(cpus),
                "driver_memory": spark.conf.get("spark.driver.memory"),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
