"""The daily report as datasets, and its CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.operators import bills as bill_ops
from wattledger.settings import Settings
from wattledger.sinks.tables import REPORT_COLUMNS, write_report_csv


def report_day(
    bills: DataFrame, reconciliation: DataFrame, day: int, settings: Settings
) -> dict[str, DataFrame]:
    """Zone table, reconciliation row, five largest bills, all bills and key figures of a day."""
    rows = bills.where(F.col("sim_day") == day)
    return {
        "zones": bill_ops.report_zone_table(rows, settings).orderBy("grid_zone"),
        "reconciliation": reconciliation.where(F.col("sim_day") == day),
        "top_bills": bill_ops.top_bills(rows),
        "bills": rows.select(*REPORT_COLUMNS).orderBy("household_id"),
        "kpis": bill_ops.report_kpis(rows, settings),
    }


def write_report(bills: DataFrame, day: int, path: str) -> None:
    """CSV of one billed day; a day without bills is an error."""
    rows = bills.where(F.col("sim_day") == day)
    if rows.isEmpty():
        raise RuntimeError(f"no billing rows for sim_day={day}")
    write_report_csv(rows, path)
