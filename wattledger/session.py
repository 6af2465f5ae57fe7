"""Session helpers: the few runtime settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC; event-time text and day numbers are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder the cluster names in `spark.checkpoint.dir`.

    A session with a local master (tests) may do without the setting and gets a temporary folder;
    on a cluster a machine-local path would be invisible to the other executors, so it is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wattledger-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it is done; for rows that are read back from what was written."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)
