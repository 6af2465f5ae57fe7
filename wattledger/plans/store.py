"""Where the tables live and how their logs are read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wattledger import schemas
from wattledger.functions.clock import date_of, hour_of, instant
from wattledger.operators import alerts, consumption, reconciliation
from wattledger.settings import Settings
from wattledger.sources.files import Folder, partition_folders
from wattledger.sources.lake import scan_lake
from wattledger.sources.tables import scan_table

ALERT_CHANGE = StructType(
    [*schemas.ALERT.fields, *schemas.columns("transition string, pass_id bigint").fields]
)
TARIFF_ROW = schemas.columns(
    "household_id string, raw_rate string, tariff_rate double, billing_tier string, "
    "subsidy_flag boolean, published_at string, is_valid boolean, sim_day int, run_id string"
)
CLOSED_TOTAL = schemas.columns(
    "household_id string, grid_zone string, consumption_kwh double, solar_kwh double, "
    "reading_count bigint, last_event_time timestamp, through_batch bigint, sim_day int"
)
GAUGE_SAMPLE = schemas.columns(
    "name string, label string, value double, sampled_at timestamp, sampled_on date"
)
CLOSURE = schemas.columns("id bigint, closed_at timestamp")
UNBILLED = schemas.columns("household_id string, sim_day int, run_id string")


@dataclass(frozen=True)
class Store:
    """All tables below one root; a table nobody has written yet reads as empty."""

    root: str

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def lake_path(self) -> str:
        return self._path("raw_readings")

    @property
    def quarantine_path(self) -> str:
        return self._path("quarantine")

    @property
    def zone_windows_path(self) -> str:
        return self._path("zone_windows")

    @property
    def partial_totals_path(self) -> str:
        return self._path("household_partials")

    @property
    def closed_totals_path(self) -> str:
        return self._path("household_totals")

    @property
    def quality_path(self) -> str:
        return self._path("stream_quality")

    @property
    def heartbeats_path(self) -> str:
        return self._path("heartbeats")

    @property
    def daily_path(self) -> str:
        return self._path("household_daily")

    @property
    def tariff_rows_path(self) -> str:
        return self._path("tariff_rows")

    @property
    def tariffs_path(self) -> str:
        return self._path("tariff_reference")

    @property
    def bills_path(self) -> str:
        return self._path("bills")

    @property
    def household_state_path(self) -> str:
        return self._path("household_state")

    @property
    def priced_live_path(self) -> str:
        return self._path("priced_live")

    @property
    def unbilled_path(self) -> str:
        return self._path("unbilled_households")

    @property
    def reconciliation_path(self) -> str:
        return self._path("reconciliation")

    @property
    def alerts_path(self) -> str:
        return self._path("alert_changes")

    @property
    def open_alerts_path(self) -> str:
        return self._path("open_alerts")

    @property
    def resolved_alerts_path(self) -> str:
        return self._path("resolved_alerts")

    @property
    def closures_path(self) -> str:
        return self._path("alert_closures")

    @property
    def run_log_path(self) -> str:
        return self._path("run_log")

    @property
    def gauge_samples_path(self) -> str:
        return self._path("gauge_samples")

    def checkpoint_path(self, query: str) -> str:
        return self._path(f"_checkpoints/{query}")

    def holds_batches(self, spark: SparkSession) -> bool:
        """Whether any micro-batch has been written."""
        folder = Folder(spark, self.root)
        logs = ("zone_windows", "stream_quality")
        return any(folder.names(f"{name}/hour=*/batch_id=*") for name in logs)

    def read(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        where: Column | str | None = None,
    ) -> DataFrame:
        try:
            return scan_table(spark, path, schema, where)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        return self._nothing(spark, schema)

    def read_days(
        self, spark: SparkSession, path: str, schema: StructType, days: Sequence[int] | None
    ) -> DataFrame:
        """Rows of some days, listing only their folders; of all days for None.

        A table partitioned by day and micro-batch has thousands of folders per day, and Spark
        lists all of them before it prunes.
        """
        if days is None:
            return self.read(spark, path, schema)
        folders = partition_folders(spark, path, "sim_day", days)
        if not folders:
            return self._nothing(spark, schema)
        return spark.read.schema(schema).option("basePath", path).parquet(*folders)

    @staticmethod
    def _nothing(spark: SparkSession, schema: StructType) -> DataFrame:
        nullable = StructType([StructField(f.name, f.dataType) for f in schema])
        return spark.createDataFrame([], nullable)

    def lake(self, spark: SparkSession, days: Sequence[int] | None = None) -> DataFrame:
        """Clean readings, each micro-batch from its own folder or from its day's compact form."""
        return scan_lake(spark, self.lake_path, days)

    def last_batch(self, spark: SparkSession) -> int | None:
        """The newest micro-batch with a quality row, which is written last.

        The stream may repeat this batch after a failure, but none before it.
        """
        hours = self.hours(spark, self.quality_path)
        names = Folder(spark, self.quality_path).names(f"hour={hours[-1]}/batch_id=*") if hours else []
        return max((int(name.partition("=")[2]) for name in names), default=None)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, self.quarantine_path, schemas.QUARANTINE)

    def _read_hours(
        self, spark: SparkSession, path: str, schema: StructType, first: int | None, last: int | None
    ) -> DataFrame:
        """Rows of the hour folders from `first` to `last`, listing only these; of all for None."""
        if first is None and last is None:
            return self.read(spark, path, schema).select(*schema.fieldNames())
        hours = self.hours(spark, path)
        wanted = [h for h in hours if (first is None or h >= first) and (last is None or h <= last)]
        if not wanted:
            return self._nothing(spark, schema)
        folders = partition_folders(spark, path, "hour", wanted)
        reader = spark.read.schema(schema).option("basePath", path)
        return reader.parquet(*folders).select(*schema.fieldNames())

    @staticmethod
    def hours(spark: SparkSession, path: str) -> list[int]:
        return sorted(int(name.partition("=")[2]) for name in Folder(spark, path).names("hour=*"))

    def zone_windows(
        self, spark: SparkSession, since: datetime | str | None = None, until: datetime | str | None = None
    ) -> DataFrame:
        """Zone windows, newest versions; with bounds, of the hours of starts in between.

        All versions of a window are in the hour of its start.
        """
        first, last = (None if at is None else hour_of(at) for at in (since, until))
        return consumption.zone_window_view(
            self._read_hours(spark, self.zone_windows_path, schemas.ZONE_WINDOW, first, last)
        )

    def grid_history(
        self, spark: SparkSession, as_of: datetime | str, minutes: int, settings: Settings
    ) -> DataFrame:
        """The zone windows that view_grid_history() of these minutes can need."""
        earliest = minutes * 60 + settings.window_seconds
        log = self._read_hours(
            spark, self.zone_windows_path, schemas.ZONE_WINDOW, hour_of(as_of, earliest), hour_of(as_of)
        )
        return consumption.zone_window_view(log)

    def running_totals(
        self,
        spark: SparkSession,
        settings: Settings,
        days: Sequence[int] | None = None,
        through: int | None = None,
    ) -> DataFrame:
        """Running totals: what a day's compact form holds plus the partials after it.

        `through` leaves out later micro-batches.
        """
        partials = self.read_days(spark, self.partial_totals_path, schemas.RUNNING_TOTAL, days)
        if through is not None:
            partials = partials.where(F.col("batch_id") <= through)
        closed = self.read_days(spark, self.closed_totals_path, CLOSED_TOTAL, days)
        folded = closed.select("sim_day", "through_batch").distinct()
        later = partials.join(folded, "sim_day", "left").where(
            F.col("through_batch").isNull() | (F.col("batch_id") > F.col("through_batch"))
        )
        parts = later.drop("batch_id").unionByName(closed)
        return consumption.running_totals(parts, settings)

    def quality(self, spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
        """Quality rows, one per micro-batch; with bounds, of the hours in between."""
        log = self._read_hours(spark, self.quality_path, schemas.STREAM_QUALITY, first, last)
        return consumption.latest_update(log, ("batch_id",), "recorded_at")

    def recent_quality(self, spark: SparkSession, as_of: datetime | str, settings: Settings) -> DataFrame:
        """Quality rows of the hours that rules, roll-ups and the recent lag look at.

        They are those of the roll-up's window, and as many earlier ones as hold the micro-batches
        that the lag is taken from.
        """
        now, lower = hour_of(as_of), hour_of(as_of, settings.quality_window_seconds)
        folder, batches, first = Folder(spark, self.quality_path), 0, now
        for hour in reversed([h for h in self.hours(spark, self.quality_path) if h <= now]):
            if hour < lower and batches >= settings.lag_batches:
                break
            first = hour
            # Some batches of the present hour may be later than `as_of`.
            batches += len(folder.names(f"hour={hour}/batch_id=*")) if hour < now else 0
        return self.quality(spark, min(first, lower), now)

    def quality_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The quality row of one micro-batch; none for an empty one."""
        folders = Folder(spark, self.quality_path).paths(f"hour=*/batch_id={batch_id}")
        if not folders:
            return self._nothing(spark, schemas.STREAM_QUALITY)
        reader = spark.read.schema(schemas.STREAM_QUALITY).option("basePath", self.quality_path)
        rows = reader.parquet(*folders).select(*schemas.STREAM_QUALITY.fieldNames())
        return consumption.latest_update(rows, ("batch_id",), "recorded_at")

    def heartbeats(self, spark: SparkSession) -> DataFrame:
        """The newest complete version of every component's heartbeat."""
        folder = Folder(spark, self.heartbeats_path)
        newest: dict[str, str] = {}
        for path in folder.paths("component=*/version=*/_SUCCESS"):
            version = path.rpartition("/")[0]
            of = version.rpartition("/")[0]
            newest[of] = max(version, newest.get(of, version))
        if not newest:
            return self._nothing(spark, schemas.HEARTBEAT)
        return spark.read.schema(schemas.HEARTBEAT).parquet(*sorted(newest.values()))

    def _since(self, spark: SparkSession, path: str, schema: StructType, key: str, since) -> DataFrame:
        """Rows of the date folders from the date of `since` on, listing only these."""
        folder = Folder(spark, path)
        first = "" if since is None else date_of(since)
        days = [n for n in folder.names(f"{key}=*") if n.partition("=")[2] >= first]
        if not days:
            return self._nothing(spark, schema)
        reader = spark.read.schema(schema).option("basePath", path)
        return reader.parquet(*(folder.child(n) for n in days)).select(*schema.fieldNames())

    def run_log(self, spark: SparkSession, since=None) -> DataFrame:
        return self._since(spark, self.run_log_path, schemas.RUN_LOG, "finished_on", since)

    def closures(self, spark: SparkSession, since=None) -> DataFrame:
        return self._since(spark, self.closures_path, CLOSURE, "closed_on", since)

    def gauge_samples(self, spark: SparkSession, since=None) -> DataFrame:
        """Stored gauge samples; with `since` only the folders from that date on are read."""
        where = None if since is None else F.col("sampled_on") >= F.to_date(instant(since))
        rows = self.read(spark, self.gauge_samples_path, GAUGE_SAMPLE, where)
        return rows.drop("sampled_on")

    def reconciliation(self, spark: SparkSession) -> DataFrame:
        log = self.read(spark, self.reconciliation_path, schemas.RECONCILIATION)
        return reconciliation.latest_reconciliation(log)

    def _committed(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        days: Sequence[int] | None = None,
    ) -> DataFrame:
        rows = self.read_days(spark, path, schema, days)
        return reconciliation.committed(rows, self.reconciliation(spark))

    def daily(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, self.daily_path, schemas.HOUSEHOLD_DAILY)

    def tariffs(self, spark: SparkSession, days: Sequence[int] | None = None) -> DataFrame:
        return self._committed(spark, self.tariffs_path, schemas.TARIFF_REFERENCE, days)

    def bills(self, spark: SparkSession, days: Sequence[int] | None = None) -> DataFrame:
        return self._committed(spark, self.bills_path, schemas.BILL, days)

    def newest_bills(self, spark: SparkSession) -> DataFrame:
        """Bills of the newest billed day; the small reconciliation table says which it is."""
        day = reconciliation.newest_billed_day(self.reconciliation(spark)).first()[0]
        return self.bills(spark, [] if day is None else [day])

    def unbilled(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, self.unbilled_path, UNBILLED)

    def tariff_rows(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, self.tariff_rows_path, TARIFF_ROW)

    def _open_generation(self, spark: SparkSession, before: int | None) -> tuple[str | None, int]:
        """Folder and pass of the newest complete generation of open alerts."""
        complete = Folder(spark, self.open_alerts_path).paths("pass=*/_SUCCESS")
        passes = {int(p.rpartition("/")[0].rpartition("pass=")[2]): p.rpartition("/")[0] for p in complete}
        known = [n for n in passes if before is None or n < before]
        return (passes[max(known)], max(known)) if known else (None, -1)

    def open_alerts(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Open alerts after the newest pass (before pass `before`): one folder is read."""
        path, _ = self._open_generation(spark, before)
        return self._nothing(spark, schemas.ALERT) if path is None else spark.read.schema(schemas.ALERT).parquet(path)

    def resolved_alerts(self, spark: SparkSession, since=None, before: int | None = None) -> DataFrame:
        """Alerts that committed passes resolved, from the date of `since` on."""
        _, newest = self._open_generation(spark, before)
        schema = StructType([*schemas.ALERT.fields, StructField("pass_id", LongType())])
        rows = self._since(spark, self.resolved_alerts_path, schema, "resolved_on", since)
        return rows.where(F.col("pass_id") <= newest).drop("pass_id")

    def alerts(self, spark: SparkSession, since=None, before: int | None = None) -> DataFrame:
        """Open alerts and those resolved (from the date of `since` on), one row per alert."""
        return self.open_alerts(spark, before).unionByName(self.resolved_alerts(spark, since, before))

    def alert_changes(self, spark: SparkSession, pass_id: int) -> DataFrame:
        """What one pass changed."""
        folders = partition_folders(spark, self.alerts_path, "pass_id", [pass_id])
        if not folders:
            return self._nothing(spark, ALERT_CHANGE)
        return spark.read.schema(ALERT_CHANGE).option("basePath", self.alerts_path).parquet(*folders)
