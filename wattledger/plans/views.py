"""Named views: what a consumer of the metering store asks for.

Each takes tables and an explicit `as_of`, and sorts only its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import clock
from wattledger.functions.clock import instant, seconds_before
from wattledger.functions.exact import half_up
from wattledger.operators import alerts as alert_ops
from wattledger.operators import bills as bill_ops
from wattledger.operators import grid, health, reconciliation, tariffs
from wattledger.operators.consumption import with_energy_balance
from wattledger.settings import Settings
from wattledger.streaming.speed import enrich_live_with_tariff


def view_clock(spark: SparkSession, as_of, settings: Settings) -> DataFrame:
    fraction = clock.day_fraction(instant(as_of), settings)
    return spark.range(1).select(
        clock.sim_day(instant(as_of), settings).alias("sim_day"),
        half_up(fraction, 3).alias("day_fraction"),
        clock.time_of_day(fraction).alias("sim_time_of_day"),
        clock.is_daylight(fraction, settings).alias("daylight"),
        F.lit(settings.day_seconds).alias("simulated_day_seconds"),
    )


def view_grid_live(windows: DataFrame, as_of, settings: Settings) -> DataFrame:
    latest = grid.latest_complete_window(windows, as_of)
    return grid.renewable_flags(latest, as_of, settings).orderBy("grid_zone")


def view_grid_history(
    windows: DataFrame,
    as_of,
    minutes: int = 15,
    settings: Settings | None = None,
    wide: bool = False,
) -> DataFrame:
    """Windows closed within the last minutes; `wide` puts the load of each zone in a column."""
    if not 1 <= minutes <= 360:
        raise ValueError("minutes must be between 1 and 360")
    recent = windows.where(
        (F.col("window_end") <= instant(as_of))
        & (F.col("window_end") > seconds_before(as_of, minutes * 60))
    ).select(
        "grid_zone", "window_end", "total_consumption_kwh", "total_solar_kwh", "renewable_pct"
    )
    if wide:
        zones = list((settings or Settings()).zones)
        pivoted = recent.groupBy("window_end").pivot("grid_zone", zones)
        recent = pivoted.agg(F.first("total_consumption_kwh"))
    return recent.orderBy("window_end", *([] if wide else ["grid_zone"]))


def current_day(as_of, settings: Settings):
    return clock.sim_day(instant(as_of), settings)


def view_households_live(
    running: DataFrame, as_of, settings: Settings, sim_day: int | None = None
) -> DataFrame:
    """Running totals of a day, of the current one by default."""
    day = F.lit(sim_day) if sim_day is not None else current_day(as_of, settings)
    return (
        running.where(F.col("sim_day") == day)
        .select(
            "household_id",
            "sim_day",
            "grid_zone",
            "consumption_kwh",
            "solar_kwh",
            "reading_count",
            "last_event_time",
        )
        .orderBy("household_id")
    )


def view_billing_daily(
    bills: DataFrame, sim_day: int | None = None, household_id: str | None = None
) -> DataFrame:
    """Bills of a day, the newest of `bills` by default; `Store.newest_bills` reads no other."""
    rows = bill_ops.point_filters(bill_ops.bills_of_day(bills, sim_day), household_id)
    return rows.orderBy("household_id")


def view_billing_summary(
    bills: DataFrame, settings: Settings, sim_day: int | None = None
) -> DataFrame:
    day = bill_ops.bills_of_day(bills, sim_day)
    return bill_ops.billing_zone_summary(day, settings).orderBy("grid_zone")


def view_billing_days(recon: DataFrame) -> DataFrame:
    return reconciliation.billing_days(recon)


def view_reconciliation(recon: DataFrame, limit: int = 10) -> DataFrame:
    return reconciliation.reconciliation_recent(recon, limit)


def view_billing_projection(
    running: DataFrame,
    tariff_reference: DataFrame,
    bills: DataFrame,
    as_of,
    settings: Settings,
    household_id: str | None = None,
) -> DataFrame:
    """Provisional bills of the running day: live totals at the latest tariff.

    A household without any tariff has no amount yet. The last final bill stands beside it.
    """
    latest = tariffs.latest_tariff_per_household(tariff_reference)
    state = latest.join(bill_ops.latest_bill_per_household(bills), "household_id", "full")
    return view_billing_projection_from(running, state, as_of, settings, household_id)


def view_billing_projection_from(
    running: DataFrame, state: DataFrame, as_of, settings: Settings, household_id: str | None = None
) -> DataFrame:
    """view_billing_projection() from the state of the households that snapshots keep."""
    live = running.where(F.col("sim_day") == current_day(as_of, settings))
    if household_id is not None:
        live, state = (bill_ops.point_filters(rows, household_id) for rows in (live, state))
    priced = enrich_live_with_tariff(live, state)
    balanced = with_energy_balance(priced, settings, "consumption_kwh", "solar_kwh")
    billed = bill_ops.with_bill(balanced, settings, "provisional_bill_so_far")
    has_tariff = F.col("tariff_rate").isNotNull()
    return billed.select(
        "household_id",
        "grid_zone",
        "consumption_kwh",
        "solar_kwh",
        "reading_count",
        "tariff_rate",
        "billing_tier",
        "subsidy_flag",
        "tariff_sim_day",
        "last_final_bill",
        "last_final_sim_day",
        half_up(F.col("net_consumption_kwh"), 3).alias("net_consumption_kwh"),
        "solar_contribution_pct",
        "provisional_bill_so_far",
        F.when(has_tariff, F.lit("provisional"))
        .otherwise(F.lit("awaiting_first_tariff"))
        .alias("status"),
    ).orderBy("household_id")


def view_alerts(alerts: DataFrame, resolved: bool = False, limit: int = 50) -> DataFrame:
    return alert_ops.alerts_list(alerts, resolved, limit)


def view_health(
    spark: SparkSession, heartbeats: DataFrame, as_of, settings: Settings
) -> DataFrame:
    states = health.component_state(heartbeats, as_of, settings)
    return health.health_overall(spark, states, settings)


def view_pipeline_status(
    heartbeats: DataFrame, quality: DataFrame, as_of, settings: Settings
) -> DataFrame:
    """Component states, stream quality and reject reasons as (section, name, status, value)."""
    states = health.component_state(heartbeats, as_of, settings).select(
        F.lit("component").alias("section"),
        F.col("component").alias("name"),
        "status",
        F.col("age_seconds").alias("value"),
    )
    rollup = grid.stream_quality_rollup(quality, as_of, settings)
    figures = F.explode(
        F.array(
            *(
                F.struct(F.lit(name).alias("name"), F.col(name).cast("double").alias("value"))
                for name in rollup.columns
            )
        )
    )
    totals = rollup.select(figures.alias("f")).select(
        F.lit("stream_quality").alias("section"), "f.name", "f.value"
    )
    reasons = grid.invalid_reason_rollup(quality, as_of, settings).select(
        F.lit("invalid_by_reason").alias("section"),
        F.col("reason").alias("name"),
        F.col("n").cast("double").alias("value"),
    )
    return states.unionByName(totals, allowMissingColumns=True).unionByName(
        reasons, allowMissingColumns=True
    )
