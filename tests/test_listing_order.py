"""Listings come in their order: the comparison of registered queries ignores it."""

import pytest

from verification import compare
from verification.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"

ALERTS = "triggered_at DESC, alert_type, scope"
LISTINGS = {
    "view_grid_live": "grid_zone",
    "view_grid_history": "window_end, grid_zone",
    "view_households_live": "household_id",
    "view_billing_daily": "household_id",
    "view_billing_summary": "grid_zone",
    "view_billing_days": "sim_day DESC",
    "view_reconciliation": "sim_day DESC",
    "view_billing_projection": "household_id",
    "view_alerts": ALERTS,
    "alerts_list": ALERTS,
    "top_bills": "bill_amount DESC, household_id",
    "billing_days": "sim_day DESC",
    "reconciliation_recent": "sim_day DESC",
    "invalid_reason_rollup": "n DESC, reason",
    "pending_days": "sim_day",
    "report_day": "household_id",
    "report_day_zones": "grid_zone",
}


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("key", list(LISTINGS))
def test_listing_is_in_order(spark, con, key):
    names = [term.removesuffix(" DESC") for term in LISTINGS[key].split(", ")]
    rows = QUERIES[key](spark, SF).select(*names).collect()
    want = con.execute(f"SELECT {', '.join(names)} FROM ({SQL[key]}) ORDER BY {LISTINGS[key]}").fetchall()
    plain = [tuple(v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v for v in row) for row in want]
    assert [tuple(row) for row in rows] == plain
    assert len(set(plain)) == len(plain) > 0
