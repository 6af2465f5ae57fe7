"""Tariff extracts: CSV files and the markers that say a day's file is complete."""

from __future__ import annotations

import re
from collections.abc import Collection
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.once import with_computed
from wattledger.schemas import TARIFF_EXTRACT
from wattledger.sources.files import Folder

MARKER = "_SUCCESS_simday"


def scan_tariff_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Tariff rows with every column as text; empty fields are NULL."""
    return spark.read.option("header", True).schema(TARIFF_EXTRACT).csv(list(paths))


def scan_ready_days(
    spark: SparkSession, folder: str, days: Collection[int] | None = None
) -> DataFrame:
    """Days (sim_day, path) whose marker exists and names an existing file.

    With `days`, only their markers are opened; others may be as old as the folder.

    Spark's file readers skip names that start with an underscore, so the markers are read through
    the Hadoop file system the session is already connected to: one listing and one short file
    per day, never any tariff row.
    """
    files = Folder(spark, folder)
    ready = []
    for marker in files.names(f"{MARKER}*"):
        day = marker.removeprefix(MARKER)
        if not day.isdigit() or (days is not None and int(day) not in days):
            continue
        name = files.text(marker).strip()
        if name and files.exists(name):
            ready.append((int(day), files.child(name)))
    return spark.createDataFrame(ready, "sim_day int, path string")


def _bare(path: str) -> str:
    return re.sub(r"^\w+:", "", path).strip("/")


def _days_of_files(files: list[str], days: dict[str, int]) -> list[tuple[str, str]]:
    """Every file, under each form its path may have as `_metadata.file_path`, with its day."""
    known: dict[str, str] = {}
    for file in files:
        spelled = (unquote(file), file)
        homes = [home for bare in map(_bare, spelled) for home in (bare, bare.rpartition("/")[0])]
        day = next((days[home] for home in homes if home in days), None)
        if day is not None:
            for path in spelled:
                for form in (path, re.sub(r"^(\w+:)/+", r"\1/", path)):
                    known[form] = str(day)
    return list(known.items())


def scan_tariff_files(spark: SparkSession, ready: list[tuple[int, str]]) -> DataFrame:
    """Rows of many days in one scan, each stamped with the day its marker announced.

    A path may be a file or a folder of part files. A row of any other file keeps its own day.
    The day is looked up by the whole path of the row's file, which the listing knows beforehand;
    a path that is spelled otherwise is taken apart row by row.
    """
    rows = scan_tariff_csv(spark, *(path for _, path in ready))
    announced = {_bare(path): day for day, path in ready}
    files = _days_of_files(rows.inputFiles(), announced)
    listed = spark.createDataFrame(files, "listed_file string, listed_day string")
    days = F.create_map(*(F.lit(v) for path, day in announced.items() for v in (path, str(day))))
    path = F.col("_metadata.file_path")
    source = F.trim(F.regexp_replace(F.col("row_file"), r"^\w+:", ""), F.lit("/"))
    parent = F.regexp_replace(source, r"/[^/]*$", "")
    day = F.coalesce(
        "listed_day", F.try_element_at(days, source), F.try_element_at(days, parent), "sim_day"
    )
    placed = rows.withColumn("row_file", path).join(
        F.broadcast(listed), F.col("row_file") == F.col("listed_file"), "left"
    )
    # Decided once a row, not once more in every filter and join on the day.
    stamped = with_computed(placed, announced_day=day)
    return stamped.withColumn("sim_day", F.col("announced_day")).select(rows.columns)
