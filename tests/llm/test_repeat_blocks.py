"""Removal of repeated strings: batches, blocks and collections that grow with the table."""

import numpy as np
import pandas as pd
import pytest

from wattledger.llm import suffix_dedup

from .test_brute_force import removed, sha

HASH_LISTS = "block int, batch long, counts binary, hashes binary, ids binary, marks binary"


def alike(seed, count):
    """Texts of few words, so that strings of 50 bytes repeat, cut at odd places."""
    rng = np.random.default_rng(seed)
    words = ["".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(40)]
    shared = [" ".join(rng.choice(words, 60)) for _ in range(6)]
    out = {}
    for i in range(count):
        parts = [" ".join(rng.choice(words, rng.integers(0, 30))), shared[rng.integers(6)][rng.integers(40) :]]
        out[i] = "é ".join(parts[:: 1 - 2 * int(rng.integers(2))])
    return out


def test_one_row_for_a_block_of_many_arrow_batches(spark):
    rng = np.random.default_rng(5)
    texts = [(i, i, bytes(rng.integers(97, 123, 400).astype(np.uint8))) for i in range(2000)]
    docs = spark.createDataFrame(texts, "id long, mark long, text binary").coalesce(1)
    suffix_dedup.text_batches(spark)
    rows = docs.mapInPandas(suffix_dedup._hash_lists(7), HASH_LISTS).collect()
    assert sorted(r["block"] for r in rows) == list(range(7))
    assert len({r["batch"] for r in rows}) == 1


def test_rows_grow_slower_than_the_square_of_the_input():
    blocks = [suffix_dedup.block_count(n) for n in (0, 1, 10**8, 10**9, 10**10, 10**12)]
    assert blocks[:2] == [1, 1]
    assert blocks[2:4] == [-(-n // suffix_dedup.BLOCK_BYTES) for n in (10**8, 10**9)]
    assert blocks[4] == suffix_dedup.FAN_OUT
    assert blocks[5] * suffix_dedup.GROWN * suffix_dedup.BLOCK_BYTES >= 10**12


def test_grown_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FAN_OUT", 3)
    texts = alike(2, 60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, block_bytes=1000).collect()}
    for i, (n, _, runs, digest) in removed(texts).items():
        assert (got[i]["n_bytes"], len(got[i]["starts"] or []), sha(bytes(got[i]["kept"]))) == (n, runs, digest)


class _Task:
    number = 0

    @classmethod
    def get(cls):
        return cls

    @classmethod
    def partitionId(cls):
        return cls.number


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_any_size_of_batches_and_collections(monkeypatch, size):
    """All steps in this process, with parts that hold one text, some or all."""
    for name in ("BATCH_BYTES", "PIECE_BYTES", "COLLECTION_BYTES", "OCCURRENCES"):
        monkeypatch.setattr(suffix_dedup, name, size)
    monkeypatch.setattr(suffix_dedup, "TaskContext", _Task)
    texts = alike(size, 50)
    frame = pd.DataFrame([(i, i, t.encode()) for i, t in texts.items()], columns=["id", "mark", "text"])
    frame = frame[frame["text"].map(len) >= suffix_dedup.LENGTH]
    frames = [x for _, x in frame.groupby(np.arange(len(frame)) // 7)]
    lists = pd.concat(suffix_dedup._hash_lists(5)(frames))
    shared = pd.concat(suffix_dedup._shared(x) for _, x in lists.groupby("block"))
    flags = pd.concat(suffix_dedup._flags(x) for _, x in shared.groupby("batch"))
    marked = frame.merge(flags, on=["id", "mark"]).sample(frac=1, random_state=1)
    marked = pd.concat(suffix_dedup._marked_pieces(5)(x for _, x in marked.groupby(np.arange(len(marked)) // 6)))
    repeated = pd.concat(suffix_dedup._repeated(x) for _, x in marked.groupby("block"))
    spans = pd.concat(suffix_dedup._united(x) for _, x in repeated.groupby("batch")).set_index("id")
    want = {i: w for i, w in removed(texts).items() if w[1]}
    assert len(want) > 20
    assert sorted(spans.index) == sorted(want)
    for i, (_, gone, runs, _) in want.items():
        starts, stops = spans.loc[i, "starts"], spans.loc[i, "stops"]
        assert (len(starts), sum(stops) - sum(starts)) == (runs, gone)


def test_range_minima():
    rng = np.random.default_rng(0)
    for n in (1, 2, 63, 64, 65, 127, 128, 129, 1000, 5000):
        x = rng.integers(0, 200, n).astype(np.uint8)
        first = rng.integers(0, n, 300)
        last = rng.integers(first, n)
        got = suffix_dedup.RangeMinima(x).between(first, last)
        assert got.tolist() == [x[a : b + 1].min() for a, b in zip(first, last, strict=True)]
