"""Builders of small inputs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from wattledger import Settings, schemas

SETTINGS = Settings()
EPOCH = datetime(2026, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    """Naive UTC time `seconds` after the epoch, as Spark collects it in a UTC session."""
    return (EPOCH + timedelta(seconds=seconds)).replace(tzinfo=None)


def reading(event_id, seconds, household="H-1", used=1.0, made=0.5, zone="North", **changes):
    row = {
        "event_id": event_id,
        "meter_id": f"M-{household}",
        "household_id": household,
        "power_consumption_kwh": used,
        "solar_generation_kwh": made,
        "grid_zone": zone,
        "timestamp": (EPOCH + timedelta(seconds=seconds)).isoformat(),
    }
    return {**row, **changes}


def messages(spark, readings, first_offset=0):
    rows = [
        (bytearray(json.dumps(r), "utf-8"), 0, first_offset + i) for i, r in enumerate(readings)
    ]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def values(rows, *names):
    return sorted(tuple(row[n] for n in names) for row in rows.collect())
