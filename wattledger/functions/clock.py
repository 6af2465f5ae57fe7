"""Simulated clock: day numbers, day fraction and daylight derived from event time."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.settings import Settings


HOUR_MICROS = 3_600_000_000


def micros_of(as_of: datetime | str) -> int:
    """Microseconds since 1970 of an aware datetime, a naive one (taken as UTC) or ISO text."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    delta = as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def hour_of(as_of: datetime | str, seconds_earlier: float = 0) -> int:
    """Number of the hour, since 1970, of a moment or of one before it."""
    return (micros_of(as_of) - round(seconds_earlier * 1_000_000)) // HOUR_MICROS


def date_of(as_of: datetime | str, days_earlier: int = 0) -> str:
    """ISO date, in UTC, of a moment or of days before it."""
    moment = datetime(1970, 1, 1) + timedelta(microseconds=micros_of(as_of))
    return (moment - timedelta(days=days_earlier)).date().isoformat()


def event_hour(time: Column) -> Column:
    """Number of the hour, since 1970, of a timestamp column; the folder it is kept in."""
    return F.floor(F.unix_micros(time) / F.lit(HOUR_MICROS)).cast("int")


def instant(as_of: Column | datetime | str) -> Column:
    """Timestamp literal from an aware datetime, a naive one (taken as UTC) or ISO text."""
    if isinstance(as_of, Column):
        return as_of
    return F.timestamp_micros(F.lit(micros_of(as_of)))


def seconds_before(as_of: Column | datetime | str, seconds: float) -> Column:
    return F.timestamp_micros(F.unix_micros(instant(as_of)) - F.lit(round(seconds * 1_000_000)))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)).cast("double") / F.lit(1e6)


def sim_day(time: Column, settings: Settings) -> Column:
    offset = F.unix_micros(time) - F.lit(settings.epoch_micros)
    return F.floor(offset / F.lit(settings.day_micros)).cast("int")


def day_fraction(time: Column, settings: Settings) -> Column:
    offset = F.unix_micros(time) - F.lit(settings.epoch_micros)
    return F.pmod(offset, F.lit(settings.day_micros)).cast("double") / F.lit(
        float(settings.day_micros)
    )


def day_start(day: Column, settings: Settings) -> Column:
    return F.timestamp_micros(
        F.lit(settings.epoch_micros) + day.cast("long") * F.lit(settings.day_micros)
    )


def day_end(day: Column, settings: Settings) -> Column:
    return day_start(day.cast("long") + F.lit(1), settings)


def is_daylight(fraction: Column, settings: Settings) -> Column:
    """Both ends count as daylight."""
    return fraction.between(F.lit(settings.daylight_start), F.lit(settings.daylight_end))


def time_of_day(fraction: Column) -> Column:
    """`HH:MM` of a 24 hour day, truncated."""
    hours = fraction * F.lit(24.0)
    minutes = F.pmod(hours, F.lit(1.0)) * F.lit(60.0)
    return F.format_string("%02d:%02d", F.floor(hours), F.floor(minutes))
