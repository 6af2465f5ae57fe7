"""Nulls, empty and long texts, ties, repeated rows, clashing names and empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattledger.llm import (
    decontamination,
    katz,
    line_crf,
    mixing,
    quality_rules,
    secret_scan,
    simhash,
    suffix_dedup,
    token_rollup,
    url_filter,
)

PER_ROW = {
    "repeats": lambda d, labels, items: suffix_dedup.repeat_digest(d),
    "rules": lambda d, labels, items: quality_rules.quality_rules(d, labels),
    "secrets": lambda d, labels, items: secret_scan.secret_digest(d),
    "katz": lambda d, labels, items: katz.score_texts(d),
    "crf": lambda d, labels, items: line_crf.quality(d, labels),
    "bench": lambda d, labels, items: decontamination.contamination(d, items),
    "simhash": lambda d, labels, items: simhash.near_duplicates(d),
    "mix": lambda d, labels, items: mixing.mix_sources(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_result_per_row(odd, odd_rows, odd_labels, odd_items, name):
    rows = PER_ROW[name](odd, odd_labels, odd_items).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows)
    # Equal rows have equal results; in the mix they are documents of their own.
    if name != "mix":
        assert len({r for r in rows if r["doc_id"] == 3}) <= 2


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(nothing, odd_labels, odd_items, name):
    assert PER_ROW[name](nothing, odd_labels.limit(0), odd_items.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["rules", "crf", "bench"])
def test_empty_side_tables(odd, odd_rows, odd_labels, odd_items, name):
    rows = PER_ROW[name](odd, odd_labels.limit(0), odd_items.limit(0)).collect()
    assert len(rows) == len(odd_rows)
    if name == "bench":
        assert not any(r["contaminated"] for r in rows)
    if name == "crf":
        assert {r["score"] for r in rows} == {1.0}


def test_rollup(odd, nothing):
    totals = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in token_rollup.corpus_rollup(odd).collect()}
    # The null source holds two rows of document 3, the later a copy, and the text's null id, a copy, too.
    assert sum(n for (s, _, t), (n, _) in totals.items() if s is None and t == "words-1") == 3
    assert token_rollup.corpus_rollup(nothing).collect() == []


def test_stages_keep_columns(odd, odd_rows, odd_items, nothing, odd_labels):
    for docs, n in ((odd, len(odd_rows)), (nothing, 0)):
        redacted = secret_scan.redact_secrets(docs)
        assert redacted.columns == docs.columns and redacted.count() == n
        for how in ("document", "span"):
            clean = decontamination.decontaminate(docs, odd_items, how)
            assert clean.columns == docs.columns
            assert clean.count() == (n if how == "span" else clean.count())
        one = simhash.keep_one(docs)
        assert one.columns == docs.columns
        good = line_crf.keep_good(docs, odd_labels)
        assert good.columns == docs.columns and good.count() <= n
    redacted = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(odd).collect()}
    assert redacted[4] == "[secret]\n\n\n   \n"
    assert redacted[2] is None and redacted[1] == ""


def test_one_of_each_group(odd):
    kept = simhash.keep_one(odd).collect()
    groups = {r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    assert sorted(r["doc_id"] for r in kept) == sorted(groups)
    # Texts without words are one group.
    assert 1 in groups and 2 not in groups and 5 not in groups


def test_spans_are_removed(odd, odd_items):
    spans = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(odd, odd_items, "span").collect() if r["doc_id"] == 6}
    assert "word0 and0 so" not in spans[6] and "été" in spans[6]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?y#z", "http://org", "http://xorg/en/", "ftp://a.fr.com/fr/", "http://h/" + "p" * 20000]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, "http://b.com/de/1", "x")], "page_id long, url string, host string")
    rows = {r["page_id"]: r for r in url_filter.judge_urls(pages).collect()}
    assert len(rows) == len(urls) + 1
    assert (rows[4]["host"], rows[4]["path"], rows[4]["rule"], rows[4]["verdict"]) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert rows[5]["rule"] is None and rows[6]["rule"] is None
    assert rows[7]["rule"] == "com/fr/" and rows[None]["verdict"] == "block"
    assert all(rows[i]["host"] == "" and rows[i]["path"] == "" for i in range(4))
    assert url_filter.judge_urls(pages.limit(0)).collect() == []


def test_pipeline_of_odd_rows(odd, nothing, spark, tmp_path, odd_labels, odd_items):
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd_items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for kind, docs in (("odd", odd), ("nothing", nothing)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, str(tmp_path))
            if name != "mix":
                assert after.columns == docs.columns
            after.write.parquet(f"{tmp_path}/{kind}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{kind}-{name}")
