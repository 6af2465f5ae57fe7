"""Column rules against hand-computed values."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import EPOCH, SETTINGS, at, frame, messages, reading
from wattledger import Settings
from wattledger.functions import billing, clock, exact
from wattledger.operators.readings import decode_readings, grade_readings


def evaluate(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def num(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None),
        ({"power_consumption_kwh": 6.0}, None),
        ({"power_consumption_kwh": 50.0}, None),
        ({"household_id": None}, "missing_field"),
        ({"household_id": ""}, "missing_field"),
        ({"event_id": ""}, "missing_field"),
        ({"solar_generation_kwh": None}, "missing_field"),
        ({"power_consumption_kwh": "1.5"}, "missing_field"),
        ({"timestamp": "not-a-timestamp"}, "bad_timestamp"),
        ({"timestamp": "10:15"}, "bad_timestamp"),
        ({"timestamp": "2026"}, "bad_timestamp"),
        ({"timestamp": "2026-02-30T00:00:00"}, "bad_timestamp"),
        ({"grid_zone": "Atlantis"}, "unknown_zone"),
        ({"power_consumption_kwh": -0.2}, "negative_value"),
        ({"solar_generation_kwh": -0.1}, "negative_value"),
        ({"power_consumption_kwh": 999.0}, "out_of_range"),
        ({"solar_generation_kwh": 50.001}, "out_of_range"),
        ({"grid_zone": "Atlantis", "timestamp": "x"}, "bad_timestamp"),
        ({"grid_zone": "Atlantis", "power_consumption_kwh": -1.0}, "unknown_zone"),
    ],
)
def test_first_failing_check_names_the_reason(spark, changes, reason):
    decoded = decode_readings(messages(spark, [{**reading("e1", 5.0), **changes}]))
    row = grade_readings(decoded, SETTINGS).first()
    assert row["invalid_reason"] == reason


def test_malformed_message_is_a_missing_field_and_keeps_its_text(spark):
    rows = frame(spark, "value binary, partition int, offset bigint", (bytearray(b"{oops"), 1, 9))
    row = grade_readings(decode_readings(rows), SETTINGS).first()
    assert (row["invalid_reason"], row["json_str"]) == ("missing_field", "{oops")
    assert (row["partition"], row["offset"]) == (1, 9)


def test_not_a_number_is_out_of_range(spark):
    decoded = decode_readings(messages(spark, [reading("e1", 5.0)]))
    rows = decoded.withColumn("power_consumption_kwh", num("NaN"))
    assert grade_readings(rows, SETTINGS).first()["invalid_reason"] == "out_of_range"


@pytest.mark.parametrize(
    "used, made, net, export, share",
    [(5, 8, 0, 3, 100), (10, 3, 7, 0, 30), (10, 2.5, 7.5, 0, 25), (10, 40, 0, 30, 100),
     (1e8, 12344999.99996, 87655000.00004, 0, 12.34), (0, 5, 0, 5, 0), (30.008, 4.36, 25.648, 0, 14.53)],
)
def test_energy_balance(spark, used, made, net, export, share):
    c, s = num(used), num(made)
    assert evaluate(spark, billing.net_consumption(c, s, SETTINGS)) == net
    assert evaluate(spark, billing.solar_export(c, s, SETTINGS)) == export
    assert evaluate(spark, billing.solar_contribution_pct(c, s)) == share


@pytest.mark.parametrize(
    "net, rate, subsidised, amount",
    [(10, 25, False, 250), (10, 25, True, 212.5), (0, 30, False, 0), (1.2345, 18.37, False, 22.68),
     (79.861, 26.5, False, 2116.32), (25.648, 26.5, False, 679.67), (0.1, 0.05, False, 0.01)],
)
def test_bill(spark, net, rate, subsidised, amount):
    discount = billing.subsidy_discount_pct(F.lit(subsidised), SETTINGS)
    assert evaluate(spark, billing.bill_amount(num(net), num(rate), discount)) == amount


def test_bill_of_extreme_values_keeps_all_digits(spark):
    amount = billing.bill_amount(num(999999999.0), num(999999999.0), num(15.0))
    assert evaluate(spark, amount) == pytest.approx(999999999.0**2 * 0.85, rel=1e-15)


@pytest.mark.parametrize(
    "text, rate",
    [("18.5", 18.5), (" 5 ", 5.0), ("1e1", 10.0), ("-1", -1.0), ("", None), ("abc", None),
     ("NaN", None), ("Infinity", None), ("5d", None), (None, None), ("1000000000", 1e9),
     ("0.0000004", 4e-7), ("18.3712345", 18.3712345), (".5", 0.5), ("1e999", None)],
)
def test_tariff_rate_text(spark, text, rate):
    assert evaluate(spark, billing.tariff_rate(F.lit(text).cast("string"))) == rate


@pytest.mark.parametrize(
    "text, flag", [("True", True), ("1", True), ("YES", True), ("no", False), (None, False)]
)
def test_subsidy_flag(spark, text, flag):
    assert evaluate(spark, billing.subsidy_flag(F.lit(text).cast("string"))) is flag


def test_renewable_pct(spark):
    assert evaluate(spark, billing.renewable_pct(num(10), num(40))) == 100.0
    assert evaluate(spark, billing.renewable_pct(num(20), num(6.5))) == 32.5
    assert evaluate(spark, billing.renewable_pct(num(0), num(5))) == 0.0


@pytest.mark.parametrize(
    "seconds, day, fraction",
    [(0, 0, 0.0), (299.999, 0, 299.999 / 300), (300, 1, 0.0), (3.5 * 300, 3, 0.5), (-1, -1, 299 / 300)],
)
def test_clock(spark, seconds, day, fraction):
    time = clock.instant(at(seconds))
    assert evaluate(spark, clock.sim_day(time, SETTINGS)) == day
    assert evaluate(spark, clock.day_fraction(time, SETTINGS)) == pytest.approx(fraction)


def test_clock_with_a_fractional_epoch(spark):
    settings = Settings(epoch_seconds=1_000_000.5, day_seconds=10)
    time = F.timestamp_micros(F.lit(1_000_010_500_000))
    assert evaluate(spark, clock.sim_day(time, settings)) == 1
    assert evaluate(spark, clock.day_start(F.lit(1), settings).cast("double")) == 1_000_010.5
    assert evaluate(spark, clock.day_end(F.lit(1), settings).cast("double")) == 1_000_020.5


@pytest.mark.parametrize(
    "fraction, daylight", [(0.05, False), (0.4, True), (0.5, True), (0.6, True), (0.61, False)]
)
def test_daylight_includes_both_ends(spark, fraction, daylight):
    assert evaluate(spark, clock.is_daylight(num(fraction), SETTINGS)) is daylight


def test_time_of_day(spark):
    assert evaluate(spark, clock.time_of_day(num(0.4819))) == "11:33"
    assert evaluate(spark, clock.time_of_day(num(0.0))) == "00:00"


def test_instants_agree(spark):
    micros = F.unix_micros(clock.instant(EPOCH))
    assert evaluate(spark, micros) == evaluate(spark, F.unix_micros(clock.instant(at(0))))
    assert evaluate(spark, micros) == evaluate(
        spark, F.unix_micros(clock.instant("2026-01-01T01:00:00+01:00"))
    )


@pytest.mark.parametrize(
    "value, digits, rounded", [(1.005, 2, 1.01), (2.675, 2, 2.68), (-0.125, 2, -0.13), (9.45, 1, 9.5)]
)
def test_half_up(spark, value, digits, rounded):
    assert evaluate(spark, exact.half_up(num(value), digits)) == rounded


def test_fixed_text(spark):
    assert evaluate(spark, exact.fixed_text(num(9.0), 1)) == "9.0"
    assert evaluate(spark, exact.fixed_text(num(61.5), 0)) == "62"


def test_exact_sum_does_not_depend_on_order(spark):
    rows = [(0.1 * i,) for i in range(1, 2000)]
    sums = {
        spark.createDataFrame(part, "v double")
        .repartition(n)
        .agg(exact.exact_sum(F.round("v", 1), 6).alias("s"))
        .first()["s"]
        for n, part in ((1, rows), (7, rows[::-1]), (3, rows[1000:] + rows[:1000]))
    }
    assert sums == {199900.0}


def test_settings_from_text():
    settings = Settings.from_mapping({"day_seconds": "600", "zones": "A, B", "drift_pct": "2.5"})
    assert (settings.day_seconds, settings.zones, settings.drift_pct) == (600, ("A", "B"), 2.5)
    assert Settings().component_budgets["batch_layer"] == 720.0
    with pytest.raises(ValueError):
        Settings.from_mapping({"nope": "1"})
