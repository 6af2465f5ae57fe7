"""Tariff extracts: validation, newest row per household, fallback to earlier days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions import billing
from wattledger.functions.once import with_computed
from wattledger.settings import Settings

KEY = ("household_id", "sim_day")
TARIFF = ("tariff_rate", "billing_tier", "subsidy_flag")


def stamp_day(extract: DataFrame, day: int) -> DataFrame:
    """A single-day extract belongs to the day it was requested for."""
    return extract.withColumn("sim_day", F.lit(day).cast("string"))


def validate_tariff(extract: DataFrame, settings: Settings) -> DataFrame:
    """Typed tariff columns and `is_valid`; the raw rate stays for the audit of rejected rows."""
    typed = with_computed(
        extract.withColumnRenamed("tariff_rate", "raw_rate"),
        tariff_rate=billing.tariff_rate(F.col("raw_rate")),
    )
    valid = billing.is_valid_tariff(
        F.col("household_id"), F.col("tariff_rate"), F.col("billing_tier"), settings
    )
    return typed.select(
        "household_id",
        F.col("sim_day").try_cast("int").alias("sim_day"),
        "raw_rate",
        "tariff_rate",
        "billing_tier",
        billing.subsidy_flag(F.col("subsidy_flag")).alias("subsidy_flag"),
        "published_at",
        valid.alias("is_valid"),
    )


def rejected_tariff_rows(validated: DataFrame) -> DataFrame:
    return validated.where(~F.col("is_valid")).select("household_id", "sim_day", "raw_rate")


def dedup_tariff(validated: DataFrame) -> DataFrame:
    """The newest valid row per household and day, by `published_at` as text.

    Equal publication times fall back to the remaining columns, so the result never depends on
    row order. A running maximum, unlike a ranking, also shrinks copies before the shuffle.
    """
    newest = F.max(F.struct("published_at", *TARIFF)).alias("newest")
    valid = validated.where("is_valid")
    return valid.groupBy(*KEY).agg(newest).select(*KEY, *(f"newest.{c}" for c in TARIFF))


def tariff_stats(validated: DataFrame) -> DataFrame:
    """Rows, invalid rows and surplus valid rows per day."""
    by_household = validated.groupBy("sim_day", "household_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("valid")
    )
    return by_household.groupBy("sim_day").agg(
        F.sum("n").alias("tariff_rows"),
        F.sum(F.col("n") - F.col("valid")).alias("invalid_tariff_rows"),
        F.sum(F.greatest(F.col("valid") - 1, F.lit(0))).alias("duplicate_tariff_rows"),
    )


def _newest_tariff(reference: DataFrame) -> DataFrame:
    newest = F.max(F.struct("sim_day", *TARIFF)).alias("newest")
    return reference.groupBy("household_id").agg(newest)


def previous_tariffs(reference: DataFrame, day: int) -> DataFrame:
    """Last valid tariff per household from any day strictly before `day`."""
    earlier = reference.where(F.col("sim_day") < day)
    return _newest_tariff(earlier).select(
        "household_id",
        F.col("newest.sim_day").alias("prev_sim_day"),
        *(F.col(f"newest.{c}").alias(f"prev_{c}") for c in TARIFF),
    )


def latest_tariff_per_household(reference: DataFrame) -> DataFrame:
    return _newest_tariff(reference).select(
        "household_id",
        *(f"newest.{c}" for c in TARIFF),
        F.col("newest.sim_day").alias("tariff_sim_day"),
    )


def join_tariff_today(daily: DataFrame, reference: DataFrame) -> DataFrame:
    """Consumption with the tariff of its own day."""
    return daily.join(reference.select(*KEY, *TARIFF), list(KEY), "left")


def join_tariff_previous(daily: DataFrame, previous: DataFrame) -> DataFrame:
    return daily.join(previous, "household_id", "left")


def with_effective_tariff(joined: DataFrame) -> DataFrame:
    """Today's tariff if there is one, else the previous one, as a whole; plus its source."""
    def whole(prefix: str):
        names = [F.col(f"{prefix}{c}").alias(c) for c in TARIFF]
        return F.when(F.col(f"{prefix}tariff_rate").isNotNull(), F.struct(*names))

    today, previous = whole(""), whole("prev_")
    kept = [c for c in joined.columns if c not in TARIFF and not c.startswith("prev_")]
    return joined.select(
        *kept,
        billing.coalesce_tariff(today, previous).alias("tariff"),
        billing.tariff_source(F.col("tariff_rate"), F.col("prev_tariff_rate")).alias(
            "tariff_source"
        ),
    ).select(*kept, *(f"tariff.{c}" for c in TARIFF), "tariff_source")


def asof_tariff(daily: DataFrame, reference: DataFrame) -> DataFrame:
    """Every household-day with its own tariff or the last one before it, for all days at once.

    Consumption and tariffs are stacked and carried forward in day order. Each household
    contributes at most two rows per day to the window, whatever its number of readings, and the
    work is linear in the days; a join on `tariff day <= day` would grow with their square.
    """
    details = [c for c in daily.columns if c not in KEY]
    tariff = F.struct(F.col("sim_day").alias("tariff_sim_day"), *TARIFF)
    usage_rows = daily.select(*KEY, F.lit(1).alias("kind"), F.struct(*details).alias("usage"))
    tariff_rows = reference.select(*KEY, F.lit(0).alias("kind"), tariff.alias("tariff"))
    carried = (
        Window.partitionBy("household_id")
        .orderBy("sim_day", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stacked = usage_rows.unionByName(tariff_rows, allowMissingColumns=True)
    matched = stacked.withColumn("tariff", F.last("tariff", ignorenulls=True).over(carried))
    tariff_day = F.col("tariff.tariff_sim_day")
    today = F.when(tariff_day == F.col("sim_day"), tariff_day)
    return matched.where(F.col("kind") == 1).select(
        *KEY,
        "usage.*",
        *(f"tariff.{c}" for c in TARIFF),
        tariff_day.alias("tariff_sim_day"),
        billing.tariff_source(today, tariff_day).alias("tariff_source"),
    )
