"""The raw reading lake, partitioned by day and micro-batch.

A day may have a compact form: the rows of all its micro-batches up to one, in few large files. It
is a folder `_compact/sim_day=D/through=B-ID` and counts once its `_SUCCESS` is there, so the name
says what it replaces and its last file commits it. Readers take the newest form of a day and the
micro-batches after it; every batch is read exactly once, before, during and after a compaction.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wattledger.schemas import LAKE
from wattledger.sources.files import Folder

COMPACT = "_compact"


class EmptyDayError(RuntimeError):
    """The lake holds no reading for the requested day."""


@dataclass(frozen=True)
class Form:
    """A compact form of a day: `name` below the lake, and the last micro-batch in it."""

    day: int
    name: str

    @property
    def through(self) -> int:
        return int(self.name.rpartition("through=")[2].partition("-")[0])


def _forms(paths: Iterable[str]) -> list[Form]:
    """The forms of folders .../sim_day=D/through=B-ID, oldest first."""
    found = []
    for path in paths:
        _, day, name = path.rsplit("/", 2)
        found.append(Form(int(day.partition("=")[2]), f"{COMPACT}/{day}/{name}"))
    return sorted(found, key=lambda form: form.name)


def newest_forms(folder: Folder, days: Sequence[int] | None = None) -> dict[int, Form]:
    """The newest complete compact form of each of the days (None: all days) that has one."""
    wanted = "*" if days is None else f"{{{','.join(map(str, days))}}}"
    marks = folder.paths(f"{COMPACT}/sim_day={wanted}/through=*/_SUCCESS")
    return {form.day: form for form in _forms(mark.rpartition("/")[0] for mark in marks)}


def all_forms(folder: Folder, day: int) -> list[Form]:
    """All compact forms of a day, unfinished ones too."""
    return _forms(folder.paths(f"{COMPACT}/sim_day={day}/through=*"))


def batches_of(folder: Folder, day: int) -> list[int]:
    """The micro-batches that have a folder in the day."""
    return sorted(int(n.partition("=")[2]) for n in folder.names(f"sim_day={day}/batch_id=*"))


def scan_lake(spark: SparkSession, root: str, days: Sequence[int] | None = None) -> DataFrame:
    """The rows of some days, listing only their folders; of all days for None.

    Listing a lake of many years to prune it afterwards would keep the driver busy for longer than
    the job itself. Of a day with a compact form, the folders of later micro-batches are named one
    by one; a predicate on `sim_day` prunes both sides.
    """
    if days is not None and not days:
        return spark.createDataFrame([], LAKE)
    folder = Folder(spark, root)
    # Forms first: a batch that is folded while this runs is then listed as loose.
    forms = newest_forms(folder, days)
    if days is None:
        days = sorted(int(name.partition("=")[2]) for name in folder.names("sim_day=*"))
        if days and not forms:
            return spark.read.schema(LAKE).parquet(root)
    loose = []
    for day in days:
        if day in forms:
            later = (b for b in batches_of(folder, day) if b > forms[day].through)
            loose += [folder.child(f"sim_day={day}/batch_id={b}") for b in later]
        elif folder.exists(f"sim_day={day}"):
            loose.append(folder.child(f"sim_day={day}"))
    parts = []
    if loose:
        parts.append(spark.read.schema(LAKE).option("basePath", root).parquet(*loose))
    if forms:
        reader = spark.read.schema(LAKE).option("basePath", folder.child(COMPACT))
        folded = reader.parquet(*(folder.child(form.name) for form in forms.values()))
        parts.append(folded.select(*LAKE.fieldNames()))
    if not parts:
        return spark.createDataFrame([], LAKE)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def scan_lake_day(spark: SparkSession, root: str, day: int) -> DataFrame:
    """Exactly one day of the lake; an absent or empty day is an error."""
    rows = scan_lake(spark, root, [day])
    if rows.isEmpty():
        raise EmptyDayError(f"no raw events in the lake for sim_day={day}")
    return rows


def scan_lake_days(spark: SparkSession, root: str) -> DataFrame:
    """Days that have a partition. Reads no data columns, only row counts of file footers."""
    return scan_lake(spark, root).select("sim_day").distinct()
