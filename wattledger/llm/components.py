"""Connected components of an edge table by alternating stars.

Every node points to the smallest node of its neighbourhood until only stars are left (Kiveris et
al., 2014). Neighbourhoods are never gathered: a minimum is an aggregate, and going back to the edges
is a join whose other side has one row per node, so a hub is split like any skewed key. Each round
is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller or equal) neighbours of each node to its smallest one."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "of")
    tied = near.join(least, F.col("u") == F.col("of"))
    if large:
        moved = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("of").alias("u"), F.col("m").alias("v"))
        )
    return moved.where("u != v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of `edges` (u, v); root is the smallest node of its component."""
    now = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = staged(_star(_star(now, True), False), "edges")
        after = _state(now)
        if tuple(after) == tuple(state):
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
