"""Readings: decode, grade, split, day numbers, removal of repeated deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions import clock, quality, zones
from wattledger.functions.exact import half_up
from wattledger.functions.once import with_computed
from wattledger.schemas import READING
from wattledger.settings import Settings

MEASURES = ("power_consumption_kwh", "solar_generation_kwh", "event_time")
#: Bits of a stream position that hold the offset; the partition stands above them.
OFFSET_BITS = 44

DAY_COLUMNS = (
    "household_id",
    "grid_zone",
    "power_consumption_kwh",
    "solar_generation_kwh",
    "event_time",
)


def decode_readings(messages: DataFrame) -> DataFrame:
    """Message bytes to typed columns; the raw text and its position stay as lineage.

    The message is parsed once, whatever is filtered afterwards.
    """
    lineage = [c for c in messages.columns if c != "value"]
    text = F.col("value").cast("string")
    parsed = messages.select(
        F.inline(F.array(F.from_json(text, READING))), text.alias("json_str"), *lineage
    )
    return parsed.withColumn("event_time", quality.parse_event_time(F.col("timestamp")))


def grade_readings(readings: DataFrame, settings: Settings) -> DataFrame:
    """Adds `invalid_reason`, NULL for a clean reading, judged once per row."""
    return with_computed(readings, invalid_reason=quality.invalid_reason(settings))


def split_clean(graded: DataFrame) -> DataFrame:
    return graded.where(F.col("invalid_reason").isNull()).drop("invalid_reason")


def split_invalid(graded: DataFrame) -> DataFrame:
    return graded.where(F.col("invalid_reason").isNotNull())


def with_sim_day(readings: DataFrame, settings: Settings) -> DataFrame:
    """Day number of the event time; readings before the epoch are dropped."""
    day = clock.sim_day(F.col("event_time"), settings)
    return readings.withColumn("sim_day", day).where(F.col("sim_day") >= 0)


def with_day_fraction(rows: DataFrame, settings: Settings, time: str = "event_time") -> DataFrame:
    return rows.withColumn("day_fraction", clock.day_fraction(F.col(time), settings))


def with_daylight(rows: DataFrame, settings: Settings, time: str = "event_time") -> DataFrame:
    fraction = clock.day_fraction(F.col(time), settings)
    return rows.withColumn("daylight", clock.is_daylight(fraction, settings))


def with_time_of_day(rows: DataFrame, settings: Settings, time: str = "event_time") -> DataFrame:
    """Fraction rounded to three decimals next to the `HH:MM` of the unrounded one."""
    exact = clock.day_fraction(F.col(time), settings)
    return rows.withColumns(
        {
            "day_fraction": half_up(exact, 3),
            "sim_time_of_day": clock.time_of_day(exact),
        }
    )


def day_bounds(days: DataFrame, settings: Settings) -> DataFrame:
    day = F.col("sim_day")
    return days.withColumns(
        {"day_start": clock.day_start(day, settings), "day_end": clock.day_end(day, settings)}
    )


def _first_delivery(readings: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Keep the copy with the lowest stream position per key.

    As an aggregate, every map task sends at most one copy of a key across the shuffle, so a
    reading delivered a billion times costs its reducer one row per map task.
    """
    first = F.min_by(F.struct(*payload), F.struct("partition", "offset")).alias("first")
    return readings.groupBy(*keys).agg(first).select(*keys, "first.*")


def dedup_global(readings: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """One row per reading and day, over all batches.

    `columns` names what the caller needs; only these cross the shuffle.
    """
    keys = ["sim_day", "event_id"]
    wanted = columns or readings.columns
    return _first_delivery(readings, keys, [c for c in wanted if c not in keys])


def first_measures(readings: DataFrame, settings: Settings) -> DataFrame:
    """What exact days need of clean readings, one row per reading and day, over all batches.

    The copy with the lowest stream position counts. All that is kept of it has a fixed width (the
    position is one number, the zone another), so copies are removed in hash tables, without a sort
    on either side of the shuffle. A reading is an event of a household: copies that disagree about
    the household are readings of both.
    """
    place = F.shiftleft(F.col("partition").cast("long"), OFFSET_BITS).bitwiseOR(F.col("offset"))
    zone = zones.zone_number(F.col("grid_zone"), settings)
    narrow = readings.select(
        "sim_day", "event_id", "household_id", *MEASURES, zone.alias("zone"), place.alias("place")
    )
    kept = (*MEASURES, "zone")
    first = narrow.groupBy("sim_day", "event_id", "household_id").agg(
        *(F.min_by(c, "place").alias(c) for c in kept)
    )
    return first.select(
        "sim_day", "event_id", "household_id", *MEASURES, zones.zone_name(F.col("zone"), settings).alias("grid_zone")
    )


def dedup_microbatch(readings: DataFrame) -> DataFrame:
    """One row per reading within a micro-batch; copies in other batches stay."""
    keys = ["batch_id", "event_id"]
    return _first_delivery(readings, keys, [c for c in readings.columns if c not in keys])


def event_lag(readings: DataFrame, processed_at: str = "processed_at") -> DataFrame:
    """Seconds from event time to the start of processing."""
    lag = clock.seconds_between(F.col("event_time"), F.col(processed_at))
    return readings.withColumn("lag_seconds", lag)
