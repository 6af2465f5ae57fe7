"""Latest zone of a household as a fixed-width aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.settings import Settings


def _zone_list(settings: Settings) -> Column:
    return F.array(*map(F.lit, settings.zones))


def _bits(settings: Settings) -> int:
    return len(settings.zones).bit_length()


def zone_number(zone: Column, settings: Settings) -> Column:
    """Number of a zone from 1 on; 0 for an unknown one."""
    return F.array_position(_zone_list(settings), zone)


def zone_name(number: Column, settings: Settings) -> Column:
    return F.get(_zone_list(settings), (number - 1).cast("int"))


def zone_stamp(zone: Column, time: Column, settings: Settings) -> Column:
    """Event time and zone number in one bigint that orders by time.

    `max(zone_stamp)` finds the zone of the latest reading with an 8 byte buffer. `max_by` with
    text would force a sort of all readings before the aggregation.
    """
    number = F.array_position(_zone_list(settings), zone)
    return F.shiftleft(F.unix_micros(time), _bits(settings)) + number


def zone_of(stamp: Column, settings: Settings) -> Column:
    number = stamp.bitwiseAND(F.lit((1 << _bits(settings)) - 1)).cast("int")
    return F.element_at(_zone_list(settings), number)
