"""The sketch behind the household counts keeps its tolerance in every one of many windows."""

from pyspark.sql import functions as F

from tests.helpers import EPOCH, SETTINGS
from wattledger.operators import consumption


def test_every_window_counts_its_households_within_the_tolerance(spark):
    rows = spark.range(3000 * 600).select(
        F.concat(F.lit("H-"), F.col("id")).alias("household_id"),
        F.lit("North").alias("grid_zone"),
        F.lit(1.0).alias("power_consumption_kwh"),
        F.lit(0.5).alias("solar_generation_kwh"),
        F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.floor(F.col("id") / 600) * 15).alias("event_time"),
    )
    windows = consumption.zone_window_metrics(rows, SETTINGS)
    # Every household reads once, so the events of a window are its households.
    off = F.abs(F.col("household_count") - F.col("event_count")) > 1 + 0.15 * F.col("event_count")
    assert windows.count() > 3000
    assert windows.where(off).isEmpty()
