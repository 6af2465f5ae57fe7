"""Bills from consumption that already carries its tariff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions import billing
from wattledger.functions.exact import exact_sum, from_units, half_up, money_sum, to_units
from wattledger.settings import Settings

BILL_COLUMNS = (
    "household_id",
    "sim_day",
    "grid_zone",
    "total_consumption_kwh",
    "total_solar_kwh",
    "net_consumption_kwh",
    "solar_export_kwh",
    "solar_contribution_pct",
    "tariff_rate",
    "billing_tier",
    "subsidy_flag",
    "subsidy_discount_pct",
    "tariff_source",
    "bill_amount",
)


def with_bill(rows: DataFrame, settings: Settings, name: str = "bill_amount") -> DataFrame:
    discount = billing.subsidy_discount_pct(F.col("subsidy_flag"), settings)
    return rows.withColumn("subsidy_discount_pct", discount).withColumn(
        name,
        billing.bill_amount(
            F.col("net_consumption_kwh"), F.col("tariff_rate"), F.col("subsidy_discount_pct")
        ),
    )


def compute_bills(enriched: DataFrame, settings: Settings) -> DataFrame:
    """Bills of every household-day with a tariff."""
    billable = enriched.where(F.col("tariff_source") != billing.MISSING)
    return with_bill(billable, settings).select(*BILL_COLUMNS)


def unbilled_households(enriched: DataFrame) -> DataFrame:
    """Household-days with no tariff on the day or before."""
    missing = enriched.where(F.col("tariff_source") == billing.MISSING)
    return missing.select("household_id", "sim_day")


def latest_billed_day(bills: DataFrame) -> DataFrame:
    return bills.agg(F.max("sim_day").alias("sim_day"))


def bills_of_day(bills: DataFrame, day: int | None = None) -> DataFrame:
    """Bills of one day, of the newest billed day by default."""
    if day is not None:
        return bills.where(F.col("sim_day") == day)
    return bills.join(latest_billed_day(bills), "sim_day", "left_semi")


def point_filters(
    rows: DataFrame, household_id: str | None = None, sim_day: int | None = None
) -> DataFrame:
    if household_id is not None:
        rows = rows.where(F.col("household_id") == household_id)
    if sim_day is not None:
        rows = rows.where(F.col("sim_day") == sim_day)
    return rows


def latest_bill_per_household(bills: DataFrame) -> DataFrame:
    newest = F.max(F.struct("sim_day", "bill_amount")).alias("newest")
    return (
        bills.groupBy("household_id")
        .agg(newest)
        .select(
            "household_id",
            F.col("newest.bill_amount").alias("last_final_bill"),
            F.col("newest.sim_day").alias("last_final_sim_day"),
        )
    )


def billing_zone_summary(bills: DataFrame, settings: Settings) -> DataFrame:
    """Per day and zone: households, rounded sums and averages."""
    kwh = settings.kwh_scale

    def rounded_sum(name: str, scale: int):
        return half_up(exact_sum(F.col(name), scale), 2)

    def rounded_mean(name: str, digits: int):
        mean = from_units(F.sum(to_units(F.col(name), 2)), 2) / F.count(F.lit(1))
        return half_up(mean, digits)

    return bills.groupBy("sim_day", "grid_zone").agg(
        F.count(F.lit(1)).alias("households"),
        rounded_sum("total_consumption_kwh", kwh).alias("total_consumption_kwh"),
        rounded_sum("total_solar_kwh", kwh).alias("total_solar_kwh"),
        rounded_sum("net_consumption_kwh", kwh).alias("net_consumption_kwh"),
        rounded_mean("solar_contribution_pct", 1).alias("avg_solar_contribution_pct"),
        half_up(money_sum(F.col("bill_amount")), 2).alias("total_billed"),
        half_up(money_sum(F.col("bill_amount")) / F.count(F.lit(1)), 2).alias("avg_bill"),
    )


def report_zone_table(bills: DataFrame, settings: Settings) -> DataFrame:
    """The unrounded zone table of the daily report."""
    kwh = settings.kwh_scale
    count = F.count(F.lit(1))
    return bills.groupBy("sim_day", "grid_zone").agg(
        count.alias("households"),
        exact_sum(F.col("total_consumption_kwh"), kwh).alias("consumption"),
        exact_sum(F.col("total_solar_kwh"), kwh).alias("solar"),
        (exact_sum(F.col("solar_contribution_pct"), 2) / count).alias("solar_pct"),
        money_sum(F.col("bill_amount")).alias("billed"),
    )


def report_kpis(bills: DataFrame, settings: Settings) -> DataFrame:
    kwh = settings.kwh_scale
    return bills.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("households_billed"),
        money_sum(F.col("bill_amount")).alias("total_billed"),
        exact_sum(F.col("total_consumption_kwh"), kwh).alias("consumption_kwh"),
        exact_sum(F.col("total_solar_kwh"), kwh).alias("solar_kwh"),
    )


def billed_total(rows: DataFrame, amount: str, name: str) -> DataFrame:
    """Sum of an amount to cents; rows without an amount count as zero."""
    total = money_sum(F.coalesce(F.col(amount), F.lit(0.0)))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(total, F.lit(0.0)).alias(name)
    )


def top_bills(bills: DataFrame, n: int = 5) -> DataFrame:
    """The n largest bills; equal bills in household order."""
    return bills.orderBy(F.desc("bill_amount"), "household_id").limit(n)
