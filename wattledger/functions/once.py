"""Evaluate costly columns once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read instead of computing again.

    Catalyst moves a filter below the projection it looks at by copying the expression into it, so
    a parsed time would be parsed once per use. A generator's output is not copied.
    """
    packed = F.struct(*(column.alias(name) for name, column in columns.items()))
    return rows.select("*", F.inline(F.array(packed)))
