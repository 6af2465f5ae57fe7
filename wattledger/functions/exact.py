"""Exact arithmetic on measured values.

Adding doubles gives a result that depends on the order of the rows, so two runs of one job
could disagree in the last digits. Measured values have few decimals, so they are added as whole
numbers of the smallest unit: a `bigint` sum keeps the aggregation in a hash table with
fixed-width buffers and generated code, raises on overflow in ANSI mode, and does not depend on
row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Amounts from here on are added as doubles.
LARGE = 1e10


def to_units(value: Column, scale: int) -> Column:
    """Double to a whole number of 10^-scale units."""
    return F.rint(value * F.lit(float(10**scale))).cast("long")


def from_units(units: Column, scale: int) -> Column:
    return units.cast("double") / F.lit(float(10**scale))


def exact_sum(value: Column, scale: int) -> Column:
    """Order-independent sum of doubles that carry at most `scale` decimals."""
    return from_units(F.sum(to_units(value, scale)), scale)


def money_units(amount: Column) -> Column:
    """Cents of an ordinary amount, NULL beyond."""
    return F.when(F.abs(amount) < LARGE, to_units(amount, 2))


def money_beyond(amount: Column) -> Column:
    """An amount too large for sums of cents, else NULL."""
    return F.when(~(F.abs(amount) < LARGE), amount)


def money_total(units: Column, beyond: Column) -> Column:
    return from_units(F.coalesce(units, F.lit(0)), 2) + F.coalesce(beyond, F.lit(0.0))


def money_sum(amount: Column) -> Column:
    """Sum of amounts: exact in cents, but for amounts that no sum of cents could hold.

    Those are added as doubles, so one absurd rate neither ends a run nor touches the exact part.
    """
    return money_total(F.sum(money_units(amount)), F.sum(money_beyond(amount)))


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero to `digits` decimals, once.

    Spark rounds the shortest decimal text of a double, so 12.345 (stored a hair below) rounds as
    the number it stands for and 12.34499999996 rounds down.
    """
    return F.round(value.cast("double"), digits)


def fixed_text(value: Column, digits: int) -> Column:
    """Text with exactly `digits` decimals."""
    return half_up(value, digits).cast(f"decimal(38,{digits})").cast("string")
