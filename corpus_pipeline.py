"""The corpus pipeline: quality, near-duplicates, benchmark passages, secrets, mix.

Every stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the
columns of `documents`. A stage's result is written and read back before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm import decontamination, line_crf, mixing, secret_scan, simhash
from wattledger.llm.common import staged, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier predicts to be good."""
    return line_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest id."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", classify),
    ("near-duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", redact),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier is trained by gradient steps, which SQL does not express.
ORACLE_SQL = None
