"""Serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_table(
    spark: SparkSession,
    location: str,
    schema: StructType | None = None,
    where: Column | str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stored table with an optional filter, which reaches the scan.

    For `fmt="jdbc"` the location is the table name and `options` carries the connection and the
    partitioning bounds.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        rows = reader.option("dbtable", location).load()
    else:
        rows = (reader.schema(schema) if schema is not None else reader).load(location)
    return rows if where is None else rows.where(where)
