"""Reading quality: time parsing and the reason a reading is rejected."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.settings import Settings

# Reason codes in evaluation order, and the text fields a reading must carry.
MISSING_FIELD = "missing_field"
BAD_TIMESTAMP = "bad_timestamp"
UNKNOWN_ZONE = "unknown_zone"
NEGATIVE_VALUE = "negative_value"
OUT_OF_RANGE = "out_of_range"
REQUIRED_FIELDS = ("event_id", "meter_id", "household_id", "grid_zone", "timestamp")
MEASUREMENTS = ("power_consumption_kwh", "solar_generation_kwh")


def parse_event_time(text: Column) -> Column:
    """NULL for anything but a full date with optional time.

    Spark alone would also read `10:15` as a time of today, which would make a reading's day
    depend on when the job runs.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def invalid_reason(settings: Settings) -> Column:
    """The first failing check of a reading with a parsed `event_time`; NULL when clean."""
    absent = [F.col(name).isNull() | (F.col(name) == F.lit("")) for name in REQUIRED_FIELDS]
    absent += [F.col(name).isNull() for name in MEASUREMENTS]
    negative = [F.col(name) < F.lit(0.0) for name in MEASUREMENTS]
    excessive = [F.col(name) > F.lit(settings.max_reading_kwh) for name in MEASUREMENTS]
    checks = (
        (MISSING_FIELD, reduce(or_, absent)),
        (BAD_TIMESTAMP, F.col("event_time").isNull()),
        (UNKNOWN_ZONE, ~F.col("grid_zone").isin(*settings.zones)),
        (NEGATIVE_VALUE, reduce(or_, negative)),
        (OUT_OF_RANGE, reduce(or_, excessive)),
    )
    return F.coalesce(*(F.when(failed, F.lit(reason)) for reason, failed in checks))
