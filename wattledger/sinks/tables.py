"""Writers of lake, quarantine and serving tables.

Plain Parquet has no row updates. Keyed tables are therefore kept as logs whose partitions name
the writer (micro-batch, run or rule pass): repeating a write replaces its own partitions, and a
view takes the newest version of a key or adds up the parts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.clock import event_hour
from wattledger.sources.files import Folder
from wattledger.sources.lake import COMPACT

# Columns of the report, in its order.
REPORT_COLUMNS = (
    "household_id",
    "grid_zone",
    "billing_tier",
    "total_consumption_kwh",
    "total_solar_kwh",
    "net_consumption_kwh",
    "solar_export_kwh",
    "solar_contribution_pct",
    "tariff_rate",
    "tariff_source",
    "subsidy_flag",
    "subsidy_discount_pct",
    "bill_amount",
)


def replace_partitions(rows: DataFrame, path: str, keys: Sequence[str], balance: bool = True):
    """Overwrite exactly the partitions that occur in `rows`.

    The rebalance hint lets adaptive execution cut an oversized partition into several files and
    merge small ones; a plain repartition by key would put a busy day into one task.
    """
    if balance:
        rows = rows.hint("rebalance", *keys)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def sink_lake(clean: DataFrame, path: str) -> None:
    """Clean readings by day; a repeated micro-batch replaces itself."""
    replace_partitions(clean, path, ("sim_day", "batch_id"))


def sink_quarantine(invalid: DataFrame, path: str, quarantined_at) -> None:
    """Rejected readings by reason, with the time they were set aside."""
    stamped = invalid.withColumn("quarantined_at", quarantined_at)
    replace_partitions(stamped, path, ("invalid_reason", "batch_id"))


def upsert_zone_windows(windows: DataFrame, path: str, batch_id: int, updated_at) -> None:
    """The windows a micro-batch changed, as a new version of their keys, by hour of their start."""
    stamped = windows.withColumns(
        {"updated_at": updated_at, "batch_id": F.lit(batch_id), "hour": event_hour(F.col("window_start"))}
    )
    replace_partitions(stamped, path, ("hour", "batch_id"))


def upsert_running_totals(partials: DataFrame, path: str) -> None:
    """Partial totals of a micro-batch; their sum per household and day is the running total."""
    replace_partitions(partials, path, ("sim_day", "batch_id"))


def append_stream_quality(quality: DataFrame, path: str) -> None:
    """The quality row of a micro-batch, by hour of recording.

    A batch that is repeated in a later hour leaves its first row; readers take the newer one.
    """
    dated = quality.withColumn("hour", event_hour(F.col("recorded_at")))
    replace_partitions(dated, path, ("hour", "batch_id"), balance=False)


def upsert_heartbeat(heartbeats: DataFrame, path: str) -> None:
    """A new version of the given components' heartbeats, one row per component.

    A version is a folder of its own that counts once it is complete, so a reader always finds the
    one before it. Repeating a write adds an equal version; of beats with one time the one written
    last is the newest.
    """
    for beat in heartbeats.collect():
        at = int(beat["last_heartbeat"].timestamp() * 1_000_000)
        row = heartbeats.sparkSession.createDataFrame([beat], heartbeats.schema)
        version = f"version={at:020d}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        row.coalesce(1).write.parquet(f"{path}/component={beat['component']}/{version}")


def sweep_heartbeats(spark: SparkSession, path: str, grace_seconds: int) -> None:
    """Drop versions that are older than their component's newest one by more than the grace period.

    Readers that listed an older version shortly before still find it.
    """
    folder = Folder(spark, path)
    for component in folder.names("component=*"):
        complete = sorted(folder.paths(f"{component}/version=*/_SUCCESS"))
        if not complete:
            continue
        newest = complete[-1].rpartition("/")[0].rpartition("version=")[2]
        limit = int(newest.partition("-")[0]) - grace_seconds * 1_000_000
        for name in folder.names(f"{component}/version=*"):
            if int(name.partition("=")[2].partition("-")[0]) < limit:
                folder.drop(f"{component}/{name}")


def append_priced_live(priced: DataFrame, path: str, batch_id: int) -> None:
    """Live readings with their tariff; a repeated micro-batch replaces itself."""
    replace_partitions(priced.withColumn("batch_id", F.lit(batch_id)), path, ("batch_id",))


def append_run_log(runs: DataFrame, path: str) -> None:
    """Finished step runs (dag_id, task_id, sim_day, state, error, finished_at), by date."""
    dated = runs.withColumn("finished_on", F.to_date("finished_at"))
    dated.coalesce(1).write.mode("append").partitionBy("finished_on").parquet(path)


def append_gauge_samples(gauges: DataFrame, path: str, sampled_at) -> None:
    """Gauge values (name, label, value) with the time they were taken, by date."""
    stamped = gauges.withColumn("sampled_at", sampled_at)
    dated = stamped.withColumn("sampled_on", F.to_date("sampled_at"))
    dated.coalesce(1).write.mode("append").partitionBy("sampled_on").parquet(path)


def replace_day(rows: DataFrame, path: str, run_id: str, balance: bool = True) -> None:
    """A run's output of its days, not visible before the run is committed.

    Every run writes partitions of its own, so readers keep the previous run's rows until
    `upsert_reconciliation` commits the new one.
    """
    named = rows.withColumn("run_id", F.lit(run_id))
    replace_partitions(named, path, ("sim_day", "run_id"), balance)


def upsert_reconciliation(metrics: DataFrame, path: str, run_id: str, reconciled_at) -> None:
    """Commit a run: one row per day, written after all its tables. The last run of a day wins."""
    stamped = metrics.withColumns({"reconciled_at": reconciled_at, "run_id": F.lit(run_id)})
    replace_partitions(stamped, path, ("run_id",), balance=False)


def append_alert_changes(changes: DataFrame, path: str, pass_id: int) -> None:
    """The alerts a rule pass triggered, refreshed or resolved."""
    stamped = changes.withColumn("pass_id", F.lit(pass_id))
    replace_partitions(stamped, path, ("pass_id",), balance=False)


def append_resolved_alerts(changes: DataFrame, path: str, pass_id: int) -> None:
    """The alerts a pass resolved, by date."""
    resolved = changes.where("resolved").withColumns(
        {"resolved_on": F.to_date("resolved_at"), "pass_id": F.lit(pass_id)}
    )
    replace_partitions(resolved, path, ("resolved_on", "pass_id"), balance=False)


def write_open_alerts(rows: DataFrame, path: str, pass_id: int) -> None:
    """All open alerts after a pass: a generation of its own, which commits the pass."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/pass={pass_id:012d}")


def append_closure(spark: SparkSession, path: str, alert_id: int, closed_at) -> None:
    """Somebody's wish that an open alert be closed; the next pass grants it."""
    wish = spark.range(1).select(
        F.lit(alert_id).cast("long").alias("id"), closed_at.alias("closed_at"), F.to_date(closed_at).alias("closed_on")
    )
    wish.write.mode("append").partitionBy("closed_on").parquet(path)


def write_report_csv(bills: DataFrame, path: str) -> None:
    """Per-day billing CSV in household order.

    Rows are range-partitioned by day and household, so a large day becomes several ordered files
    instead of one task.
    """
    rows = bills.select("sim_day", *REPORT_COLUMNS)
    (
        rows.repartitionByRange("sim_day", "household_id")
        .sortWithinPartitions("sim_day", "household_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("sim_day")
        .csv(path)
    )


def compact_day(rows: DataFrame, root: str, day: int, through: int) -> None:
    """A day's rows of all micro-batches up to `through`, as a compact form of the day.

    The form counts once it is complete; a failed attempt leaves a folder that nobody reads.
    """
    name = f"sim_day={day}/through={through:020d}-{uuid.uuid4().hex[:8]}"
    rows.drop("sim_day").hint("rebalance").write.parquet(f"{root}/{COMPACT}/{name}")
