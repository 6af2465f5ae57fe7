"""Declared schemas. Nothing in the package infers a schema from data."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "binary": BinaryType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "string": StringType(),
    "timestamp": TimestampType(),
    "counts": MapType(StringType(), LongType()),
}


def columns(declared: str) -> StructType:
    """Struct from `name type, ...`; works before a session exists, unlike `StructType.fromDDL`."""
    schema = StructType()
    for column in declared.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


READING = columns(
    "event_id string, meter_id string, household_id string, power_consumption_kwh double, "
    "solar_generation_kwh double, grid_zone string, timestamp string"
)

# Message envelope of the reading stream; `partition` and `offset` stay with the row as lineage.
ENVELOPE = columns("value binary, partition int, offset bigint")

LAKE = columns(
    "event_id string, meter_id string, household_id string, power_consumption_kwh double, "
    "solar_generation_kwh double, grid_zone string, timestamp string, json_str string, "
    "partition int, offset bigint, event_time timestamp, sim_day int, batch_id bigint"
)

QUARANTINE = columns(
    "event_id string, meter_id string, household_id string, power_consumption_kwh double, "
    "solar_generation_kwh double, grid_zone string, timestamp string, json_str string, "
    "partition int, offset bigint, event_time timestamp, quarantined_at timestamp, "
    "invalid_reason string, batch_id bigint"
)

ZONE_WINDOW = columns(
    "grid_zone string, window_start timestamp, window_end timestamp, avg_consumption_kwh double, "
    "avg_solar_kwh double, total_consumption_kwh double, total_solar_kwh double, "
    "renewable_pct double, event_count bigint, household_count bigint, updated_at timestamp, "
    "batch_id bigint"
)

RUNNING_TOTAL = columns(
    "household_id string, consumption_kwh double, solar_kwh double, reading_count bigint, "
    "grid_zone string, last_event_time timestamp, sim_day int, batch_id bigint"
)

STREAM_QUALITY = columns(
    "total_events bigint, clean_events bigint, invalid_events bigint, duplicate_events bigint, "
    "out_of_epoch_events bigint, invalid_by_reason counts, avg_lag_seconds double, "
    "max_lag_seconds double, processing_seconds double, recorded_at timestamp, batch_id bigint"
)

HEARTBEAT = columns(
    "component string, last_heartbeat timestamp, status string, detail string"
)

# Every tariff column arrives as text; validation does the typing.
TARIFF_EXTRACT = columns(
    "household_id string, tariff_rate string, billing_tier string, subsidy_flag string, "
    "sim_day string, published_at string"
)

HOUSEHOLD_DAILY = columns(
    "household_id string, grid_zone string, total_consumption_kwh double, total_solar_kwh double, "
    "net_consumption_kwh double, solar_export_kwh double, solar_contribution_pct double, "
    "peak_reading_kwh double, reading_count bigint, sim_day int, run_id string"
)

TARIFF_REFERENCE = columns(
    "household_id string, tariff_rate double, billing_tier string, subsidy_flag boolean, "
    "sim_day int, run_id string"
)

BILL = columns(
    "household_id string, grid_zone string, total_consumption_kwh double, total_solar_kwh double, "
    "net_consumption_kwh double, solar_export_kwh double, solar_contribution_pct double, "
    "tariff_rate double, billing_tier string, subsidy_flag boolean, subsidy_discount_pct double, "
    "tariff_source string, bill_amount double, sim_day int, run_id string"
)

RECONCILIATION = columns(
    "sim_day int, speed_consumption_kwh double, batch_consumption_kwh double, drift_pct double, "
    "speed_readings bigint, batch_readings bigint, raw_events bigint, duplicates_removed bigint, "
    "tariff_rows bigint, invalid_tariff_rows bigint, duplicate_tariff_rows bigint, "
    "fallback_tariffs bigint, households_billed bigint, households_unbilled bigint, "
    "total_billed double, run_id string, reconciled_at timestamp"
)

ALERT = columns(
    "id bigint, alert_type string, scope string, severity string, message string, "
    "metric_value double, threshold double, triggered_at timestamp, last_seen_at timestamp, "
    "resolved boolean, resolved_at timestamp"
)

RUN_LOG = columns(
    "dag_id string, task_id string, sim_day int, state string, error string, finished_at timestamp"
)
