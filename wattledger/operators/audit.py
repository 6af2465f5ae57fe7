"""Checks over finished tables; an audit that finds nothing returns no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import billing
from wattledger.operators.consumption import invalid_by_reason
from wattledger.settings import Settings

TOLERANCE = 0.011


def audit_bills(bills: DataFrame, settings: Settings) -> DataFrame:
    """Bills that differ from the recomputed amount by more than the tolerance."""
    discount = billing.subsidy_discount_pct(F.col("subsidy_flag"), settings)
    expected = billing.bill_amount(F.col("net_consumption_kwh"), F.col("tariff_rate"), discount)
    checked = bills.withColumn("expected_amount", expected)
    return checked.where(
        F.abs(F.col("expected_amount") - F.col("bill_amount")) > TOLERANCE
    ).select("household_id", "sim_day", "bill_amount", "expected_amount")


def audit_zone_coverage(spark: SparkSession, latest: DataFrame, settings: Settings) -> DataFrame:
    """Zones without a live window."""
    zones = F.explode(F.array(*map(F.lit, settings.zones))).alias("grid_zone")
    expected = spark.range(1).select(zones)
    return expected.join(latest.select("grid_zone"), "grid_zone", "left_anti")


def audit_quarantine(quarantine: DataFrame) -> DataFrame:
    """How many events each reason caught, from the quarantine table."""
    return invalid_by_reason(quarantine)


def audit_lost_quarantine(quarantine: DataFrame, quality: DataFrame) -> DataFrame:
    """Micro-batches whose quarantined rows are not as many as their quality row says."""
    held = quarantine.groupBy("batch_id").agg(F.count(F.lit(1)).alias("held"))
    said = quality.groupBy("batch_id").agg(F.sum("invalid_events").alias("invalid_events"))
    compared = said.join(held, "batch_id", "full").select(
        "batch_id",
        F.coalesce("invalid_events", F.lit(0)).alias("invalid_events"),
        F.coalesce("held", F.lit(0)).alias("quarantined"),
    )
    return compared.where("invalid_events <> quarantined")
