"""Every registered query against its SQL counterpart, and the derived inputs themselves."""

import pandas as pd
import pytest

import __spark_entry__
from verification import compare, inputs
from verification.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees_with_sql(spark, con, key):
    assert compare.difference(spark, con, key, SF) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_is_lazy_and_has_the_bill_columns(spark):
    assert "bill_amount" in __spark_entry__.entry(spark).columns


def test_comparison_notices_differences():
    one = pd.DataFrame({"a": [1.0, None], "b": ["x", "y"]})
    same = one.iloc[::-1][["b", "a"]]
    assert compare.normalised(one) == compare.normalised(same)
    for other in (one.assign(a=[1.0, 2.0]), one.assign(b=["x", "z"]), one.assign(a=[1.0 + 1e-15, None])):
        assert compare.normalised(one) != compare.normalised(other)


@pytest.mark.parametrize(
    "sf, counts",
    [
        ("0.001", {"missing_field": 10, "bad_timestamp": 9, "unknown_zone": 9, "negative_value": 9,
                   "out_of_range": 378, None: 605}),
        ("0.01", {"missing_field": 101, "bad_timestamp": 99, "unknown_zone": 95,
                  "negative_value": 92, "out_of_range": 3602, None: 6211}),
    ],
)
def test_derived_readings(spark, sf, counts):
    graded = inputs.graded(spark, f"/root/testdata/sf{sf}")
    assert {r.invalid_reason: r["count"] for r in graded.groupBy("invalid_reason").count().collect()} == counts
