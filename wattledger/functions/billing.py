"""Energy balance, tariff choice and bill rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.functions.exact import from_units, half_up, to_units
from wattledger.settings import Settings

# Fixed values of `tariff_source`.
CURRENT_DAY = "current_day"
FALLBACK = "fallback_previous_day"
MISSING = "missing"

PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def renewable_pct(consumption: Column, solar: Column) -> Column:
    """Share of demand met by solar, at most 100; 0 without demand."""
    share = F.lit(100.0) * solar / consumption
    return F.when(consumption > 0, F.least(F.lit(100.0), share)).otherwise(F.lit(0.0))


def net_consumption(consumption: Column, solar: Column, settings: Settings) -> Column:
    """Consumption not covered by own solar, exact to the kept decimals."""
    scale = settings.kwh_scale
    surplus = to_units(consumption, scale) - to_units(solar, scale)
    return from_units(F.greatest(surplus, F.lit(0)), scale)


def solar_export(consumption: Column, solar: Column, settings: Settings) -> Column:
    return net_consumption(solar, consumption, settings)


def solar_contribution_pct(consumption: Column, solar: Column) -> Column:
    share = F.lit(100.0) * F.least(solar, consumption) / consumption
    return F.when(consumption > 0, half_up(share, 2)).otherwise(F.lit(0.0))


def subsidy_discount_pct(subsidised: Column, settings: Settings) -> Column:
    return F.when(subsidised, F.lit(settings.subsidy_discount_pct)).otherwise(F.lit(0.0))


def bill_amount(net: Column, rate: Column, discount_pct: Column) -> Column:
    """net x rate x (1 - discount), rounded half up to cents, once; any finite rate is billed."""
    return half_up(net * rate * (F.lit(1.0) - discount_pct / F.lit(100.0)), 2)


def tariff_rate(text: Column) -> Column:
    """Rate text to double; NULL unless it is a finite plain number.

    A cast alone would also take `NaN`, `Infinity` and `5d`, and turn `1e999` into infinity.
    """
    number = F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def subsidy_flag(text: Column) -> Column:
    return F.coalesce(F.lower(text).isin("true", "1", "yes"), F.lit(False))


def is_valid_tariff(household: Column, rate: Column, tier: Column, settings: Settings) -> Column:
    """Never NULL, so a row with an empty tier counts as invalid instead of vanishing."""
    valid = household.isNotNull() & (rate > 0) & tier.isin(*settings.tiers)
    return F.coalesce(valid, F.lit(False))


def tariff_source(today: Column, previous: Column) -> Column:
    return (
        F.when(today.isNotNull(), F.lit(CURRENT_DAY))
        .when(previous.isNotNull(), F.lit(FALLBACK))
        .otherwise(F.lit(MISSING))
    )


def coalesce_tariff(today: Column, previous: Column) -> Column:
    """Choose a whole tariff; mixing one day's rate with another day's flag is never wanted."""
    return F.coalesce(today, previous)
