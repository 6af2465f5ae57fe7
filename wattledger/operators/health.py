"""Component health and the gauges a monitor reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import clock
from wattledger.functions.clock import instant
from wattledger.functions.exact import half_up
from wattledger.operators import grid
from wattledger.settings import Settings


def latest_heartbeat(heartbeats: DataFrame) -> DataFrame:
    """The last heartbeat of every component from the append-only heartbeat log."""
    order = F.struct("last_heartbeat", "status", "detail")
    last = F.max_by(F.struct("last_heartbeat", "status", "detail"), order).alias("last")
    return heartbeats.groupBy("component").agg(last).select("component", "last.*")


def stale_budget(component: Column, settings: Settings) -> Column:
    """Seconds a component may stay silent."""
    budget = F.lit(float(settings.no_data_seconds))
    for name, seconds in settings.component_budgets.items():
        budget = F.when(component == name, F.lit(float(seconds))).otherwise(budget)
    return budget


def component_ages(heartbeats: DataFrame, as_of, settings: Settings) -> DataFrame:
    """Unrounded age and budget of every component that ever reported up to `as_of`."""
    reported = heartbeats.where(F.col("last_heartbeat") <= instant(as_of))
    return latest_heartbeat(reported).withColumns(
        {
            "age_seconds": clock.seconds_between(F.col("last_heartbeat"), instant(as_of)),
            "stale_after_seconds": stale_budget(F.col("component"), settings),
        }
    )


def component_state(heartbeats: DataFrame, as_of, settings: Settings) -> DataFrame:
    """FAILED if the component said so, STALE beyond its budget, else OK."""
    state = (
        F.when(F.col("status") != "OK", F.lit("FAILED"))
        .when(F.col("age_seconds") > F.col("stale_after_seconds"), F.lit("STALE"))
        .otherwise(F.lit("OK"))
    )
    return component_ages(heartbeats, as_of, settings).select(
        "component",
        state.alias("status"),
        half_up(F.col("age_seconds"), 1).alias("age_seconds"),
        "stale_after_seconds",
        "detail",
        "last_heartbeat",
    )


def missing_components(spark: SparkSession, states: DataFrame, settings: Settings) -> DataFrame:
    """Expected components that never reported."""
    names = F.explode(F.array(*map(F.lit, settings.expected_components)))
    expected = spark.range(1).select(names.alias("component"))
    return expected.join(states.select("component"), "component", "left_anti")


def health_overall(spark: SparkSession, states: DataFrame, settings: Settings) -> DataFrame:
    """One row: OK when every component is OK and none is missing, else DEGRADED."""
    reported = states.select("component", (F.col("status") == "OK").alias("ok"))
    absent = missing_components(spark, states, settings).select(
        "component", F.lit(False).alias("ok"), F.col("component").alias("absent")
    )
    every = reported.unionByName(absent, allowMissingColumns=True)
    return every.agg(
        F.when(F.coalesce(F.bool_and("ok"), F.lit(True)), F.lit("OK"))
        .otherwise(F.lit("DEGRADED"))
        .alias("status"),
        F.count_if(F.col("absent").isNull()).alias("components"),
        F.array_join(F.sort_array(F.collect_set("absent")), ",").alias("not_reported_yet"),
    )


def open_alerts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts.where(~F.col("resolved")).groupBy("alert_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def pipeline_gauges(
    spark: SparkSession,
    heartbeats: DataFrame,
    windows: DataFrame,
    alerts: DataFrame,
    quality: DataFrame,
    reconciliation: DataFrame,
    as_of,
    settings: Settings,
) -> DataFrame:
    """Long table (name, label, value) of every gauge; a gauge without a value has no row."""

    def gauge(rows: DataFrame, label: Column, **values: Column) -> DataFrame:
        pairs = [
            F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"))
            for name, value in values.items()
        ]
        exploded = rows.select(label.alias("label"), F.explode(F.array(*pairs)).alias("g"))
        return exploded.select("g.name", "label", "g.value")

    nothing = F.lit("")
    rollup = grid.stream_quality_rollup(quality, as_of, settings)
    outcomes = rollup.select(
        "invalid_rate_pct",
        "avg_lag_seconds",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(o).alias("outcome"), F.col(f"{o}_events").alias("events"))
                    for o in ("clean", "invalid", "duplicate")
                )
            )
        ).alias("o"),
    )
    newest_day = reconciliation.orderBy(F.desc("sim_day")).limit(1)
    states = component_state(heartbeats, as_of, settings)
    parts = [
        gauge(
            states,
            F.col("component"),
            pipeline_component_staleness_seconds=F.col("age_seconds"),
            pipeline_component_stale_budget_seconds=F.col("stale_after_seconds"),
            pipeline_component_up=F.when(F.col("status") == "OK", 1).otherwise(0),
        ),
        gauge(
            grid.latest_complete_window(windows, as_of),
            F.col("grid_zone"),
            zone_renewable_pct_latest=F.col("renewable_pct"),
            zone_load_kwh_latest=F.col("total_consumption_kwh"),
        ),
        gauge(open_alerts_by_type(alerts), F.col("alert_type"), alerts_active=F.col("n")),
        gauge(outcomes, F.col("o.outcome"), stream_events_last_5m=F.col("o.events")),
        gauge(
            rollup,
            nothing,
            stream_invalid_event_rate_pct=F.col("invalid_rate_pct"),
            stream_processing_lag_seconds=F.col("avg_lag_seconds"),
        ),
        gauge(
            newest_day,
            nothing,
            batch_last_billed_sim_day=F.col("sim_day"),
            batch_reconciliation_drift_pct=F.coalesce(F.col("drift_pct"), F.lit(0.0)),
            batch_total_billed_lkr=F.coalesce(F.col("total_billed"), F.lit(0.0)),
        ),
        gauge(
            spark.range(1), nothing, sim_day_current=clock.sim_day(instant(as_of), settings)
        ),
    ]
    gauges = parts[0]
    for part in parts[1:]:
        gauges = gauges.unionByName(part)
    return gauges.where(F.col("value").isNotNull())
