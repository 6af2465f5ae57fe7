"""Latest tariff and bill of every household, kept as a chain of snapshots.

A snapshot holds one row per household: what all committed days up to its own say. Its name is a
digest of the names of the days and runs it was made from, in order, so a day that is billed again
gives new names to its own snapshot and to all later ones; the old ones are no longer found. A
missing snapshot is made from the nearest one before it and the days since, so a daily run merges
one day into one partition, and the repair after an old bill reads only the days behind it.

Nothing has to be committed: a snapshot counts once its folder is complete, and its name says what
it must hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.operators import bills as bill_ops
from wattledger.operators import tariffs
from wattledger.plans.store import Store
from wattledger.sources.files import Folder

STATE = schemas.columns(
    "household_id string, tariff_rate double, billing_tier string, subsidy_flag boolean, "
    "tariff_sim_day int, last_final_bill double, last_final_sim_day int"
)
TARIFF_PART = (*tariffs.TARIFF, "tariff_sim_day")
BILL_PART = ("last_final_bill", "last_final_sim_day")


@dataclass(frozen=True)
class Link:
    """A committed day, and the snapshot of all days up to it."""

    day: int
    run_id: str
    name: str

    @property
    def folder(self) -> str:
        return f"sim_day={self.day}/snapshot={self.name}"


def chain(spark: SparkSession, store: Store) -> list[Link]:
    """The links of all committed days, oldest first; one row per day is read."""
    links, name = [], ""
    for row in sorted(store.reconciliation(spark).select("sim_day", "run_id").collect()):
        name = sha256(f"{name}/{row.sim_day}/{row.run_id}".encode()).hexdigest()[:32]
        links.append(Link(row.sim_day, row.run_id, name))
    return links


def _merged(base: DataFrame | None, days: DataFrame) -> DataFrame:
    """`days` over `base`, by household; tariff and bill go their own ways."""
    if base is None:
        return days
    old, new = base.alias("old"), days.alias("new")
    both = old.join(new, F.col("old.household_id") == F.col("new.household_id"), "full")
    later = []
    for part in (TARIFF_PART, BILL_PART):
        has = F.col(f"new.{part[-1]}").isNotNull()
        later += [F.when(has, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in part]
    return both.select(F.coalesce("new.household_id", "old.household_id").alias("household_id"), *later)


def _of_days(spark: SparkSession, store: Store, days: Sequence[int]) -> DataFrame:
    """The state that the given committed days alone make."""
    latest = tariffs.latest_tariff_per_household(store.tariffs(spark, days))
    billed = bill_ops.latest_bill_per_household(store.bills(spark, days))
    return latest.join(billed, "household_id", "full").select(*STATE.fieldNames())


def _nearest(folder: Folder, links: Sequence[Link]) -> int:
    """Number of links that the newest existing snapshot covers."""
    at = len(links)
    while at and not folder.exists(f"{links[at - 1].folder}/_SUCCESS"):
        at -= 1
    return at


def _state(spark: SparkSession, store: Store, links: Sequence[Link]) -> tuple[DataFrame, bool]:
    """The state after `links`, and whether it is a stored snapshot."""
    folder = Folder(spark, store.household_state_path)
    held = _nearest(folder, links)
    base = None
    if held:
        base = spark.read.schema(STATE).parquet(folder.child(links[held - 1].folder))
    if held == len(links):
        return (spark.createDataFrame([], STATE) if base is None else base), True
    return _merged(base, _of_days(spark, store, [link.day for link in links[held:]])), False


def _upto(spark: SparkSession, store: Store, day: int | None) -> list[Link]:
    return [link for link in chain(spark, store) if day is None or link.day <= day]


def household_state(spark: SparkSession, store: Store, day: int | None = None) -> DataFrame:
    """Latest tariff and bill per household after all committed days (up to `day`); writes nothing.

    With a fresh snapshot one partition is read. Without a committed day it is empty.
    """
    return _state(spark, store, _upto(spark, store, day))[0]


def take_snapshot(spark: SparkSession, store: Store, day: int | None = None) -> DataFrame:
    """household_state(), stored first unless it is already."""
    links = _upto(spark, store, day)
    state, stored = _state(spark, store, links)
    if stored:
        return state
    path = Folder(spark, store.household_state_path).child(links[-1].folder)
    state.write.mode("overwrite").parquet(path)
    return spark.read.schema(STATE).parquet(path)


def previous_tariffs(state: DataFrame) -> DataFrame:
    """The tariffs of a state under the names that join_tariff_previous expects."""
    return state.where("tariff_sim_day IS NOT NULL").select(
        "household_id",
        F.col("tariff_sim_day").alias("prev_sim_day"),
        *(F.col(c).alias(f"prev_{c}") for c in tariffs.TARIFF),
    )


def latest_tariffs(state: DataFrame) -> DataFrame:
    return state.where("tariff_sim_day IS NOT NULL").select("household_id", *TARIFF_PART)


def latest_bills(state: DataFrame) -> DataFrame:
    return state.where("last_final_sim_day IS NOT NULL").select("household_id", *BILL_PART)


def sweep_snapshots(spark: SparkSession, store: Store, keep_days: int) -> list[str]:
    """Drop snapshots that no chain names any more, and those of all but the newest days.

    A dropped snapshot of an old day is made again if that day's successor is billed again; the
    oldest one kept, or all days before it, is then read.
    """
    folder = Folder(spark, store.household_state_path)
    named = {link.folder for link in chain(spark, store)[-keep_days:]}
    dropped = []
    for day in folder.names("sim_day=*"):
        for name in folder.names(f"{day}/snapshot=*"):
            if f"{day}/{name}" not in named:
                folder.drop(f"{day}/{name}")
                dropped.append(f"{day}/{name}")
    return dropped
