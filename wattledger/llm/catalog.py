"""Registered queries of this subpackage: query name to (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm import (
    decontamination,
    katz,
    line_crf,
    mixing,
    neighbours,
    oracle,
    periodic_runs,
    quality_rules,
    secret_scan,
    simhash,
    spelling,
    suffix_dedup,
    token_rollup,
    url_filter,
)
from wattledger.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.corpus_states(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(table(spark, sf_dir, "documents"))


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_token_counts,
        op3_quality_rules,
        op4_secret_scan,
        op5_katz,
        op6_line_crf,
        op7_decontamination,
        op8_simhash,
        op9_url_filter,
        op10_mixing,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_neighbours,
    )
}

SQL: dict[str, str] = dict(oracle.SQL)
