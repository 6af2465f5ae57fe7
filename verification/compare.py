"""Run registered queries against their SQL counterparts: `python -m verification.compare [sf] [key...]`."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalised(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sortable tuples with columns in name order; NaN and NaT become None."""
    ordered = frame[sorted(frame.columns)].astype(object)
    rows = ordered.where(ordered.notna(), None).itertuples(index=False, name=None)
    plain = [tuple(str(v) if isinstance(v, pd.Timestamp) else v for v in row) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def difference(spark: SparkSession, con, key: str, sf_dir: str) -> str | None:
    got = QUERIES[key](spark, sf_dir).toPandas()
    want = con.execute(SQL[key]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = normalised(got), normalised(want)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{sorted(got.columns)}\n  spark {a}\n  sql   {b}"
    kinds = [
        f"{c}: {got[c].dtype} != {want[c].dtype}"
        for c in got.columns
        if len(got) and got[c].dtype.kind != want[c].dtype.kind and got[c].notna().all()
    ]
    return f"types {kinds}" if kinds else None


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    keys = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for key in keys:
        began = time.time()
        try:
            problem = difference(spark, con, key, sf_dir)
        except Exception as error:  # noqa: BLE001 - report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{key:32} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} agree")


if __name__ == "__main__":
    main()
