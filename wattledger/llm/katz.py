"""Scores of a Katz backoff bigram model.

A seen bigram (v, w) of count r has probability d(r) r / c(v); an unseen one backs off to
alpha(v) P(w), and an unknown context to P(w). P(w) is the smoothed unigram share, with one class
for unknown words. Discounts d(1) to d(DISCOUNTED) follow Good and Turing from the numbers of
bigrams seen once, twice and so on; higher counts give up EPSILON of a count, so that no context is
left without mass. alpha(v) is the mass that the discounts free, over the unigram mass of the words
not seen after v: probabilities add up to one exactly.

Words are identified by 56 bits of a hash. Bigrams meet in the block of their second word w, where
c(w), c(v, w) and each document's share follow from one sort; frequent words, found in a sample,
are spread over the blocks by v, their exact counts taken beforehand. Blocks write tables of four
kinds: shares of documents, partial sums of contexts, unseen bigrams of held-out documents, and
numbers of bigrams by count. Contexts and unseen bigrams meet in a second, smaller step. All rows
are packed arrays; nothing of the corpus reaches the driver but the counts of counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import crc_fold, staged, text_batches
from wattledger.llm.packing import pack, unpack

DISCOUNTED = 5
EPSILON = 0.01
#: Added to every count of the unigram level (fixed by the contract).
ADDED = 0.5
FOLDS, HELD_OUT = 5, 1

BATCH_BYTES = 12 << 20
BLOCK_BYTES = 10 << 20
#: Parts of a block, by second word, that are sorted one after the other to bound memory.
PARTS = 4
#: Documents of the sample that looks for frequent words; it decides on the layout alone.
SAMPLE = 400

ID_BYTES = 7
START, END = 0, 1
ID_MASK = (1 << 8 * ID_BYTES) - 1

MARKS = "kind int, block int, batch long, a binary, b binary, c binary, d binary"


def word_id(word: bytes) -> int:
    return max(xxhash.xxh64_intdigest(word) & ID_MASK, 2)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    task, number = TaskContext.get().partitionId(), 0
    for frame in frames:
        cuts = np.cumsum(frame["text"].map(len).to_numpy()) // BATCH_BYTES
        for _, rows in frame.groupby(cuts, sort=False):
            yield (task << 32) | number, rows
            number += 1


def _frequent(sample: DataFrame, share: float) -> list[bytes]:
    """Words of at least this share of the sample's words: at most 1 / share."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: Counter[bytes] = Counter()
            for text in frame["text"]:
                seen.update(tokens(text))
            total = seen.total()
            often = [(w, n, total) for w, n in seen.items() if n >= share * total / 2]
            yield pd.DataFrame(often or [(b"", 0, total)], columns=["w", "n", "total"])

    rows = sample.repartition(1).mapInPandas(run, "w binary, n long, total long").groupBy("w").agg(
        F.sum("n").alias("n"), F.max("total").alias("total")
    )
    found = rows.where(F.col("n") >= share * F.col("total")).orderBy(F.desc("n"), "w").limit(math.ceil(1 / share)).collect()
    return [bytes(r["w"]) for r in found if r["w"]]


def _totals(often: list[bytes]) -> Callable:
    """Training tokens, training documents, and the counts of the frequent words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, docs, counts = 0, 0, dict.fromkeys(often, 0)
        for frame in frames:
            for text in frame["text"][frame["train"]]:
                w = tokens(text)
                n, docs = n + len(w) + 1, docs + 1
                if counts:
                    seen = Counter(w)
                    for x in often:
                        counts[x] += seen.get(x, 0)
        yield pd.DataFrame([(b"", n, docs), *((w, c, 0) for w, c in counts.items())], columns=["w", "n", "docs"])

    return run


def _spread(w: np.ndarray, v: np.ndarray, hot: np.ndarray, blocks: int) -> np.ndarray:
    key = np.where(np.isin(w, hot), w ^ (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(8), w)
    return (key % np.uint64(blocks)).astype(np.int64)


def _bigrams(blocks: int, hot: np.ndarray) -> Callable:
    """Per batch and block: words, their numbers, previous words and documents of all bigrams."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, rows in _batches(frames):
            number: dict[bytes, int] = {}
            local, sizes = [], []
            for text in rows["text"]:
                t = tokens(text)
                sizes.append(len(t) + 1)
                local.append(np.fromiter((number.setdefault(x, len(number)) for x in t), np.int64, len(t)))
                local.append(np.array([-1]))
            ids = np.fromiter((*map(word_id, number), END), np.uint64, len(number) + 1)
            w = ids[np.concatenate(local)]
            n = np.array(sizes)
            doc = np.repeat(np.arange(len(n)), n)
            v = np.concatenate(([np.uint64(START)], w[:-1]))
            v[v == END] = START
            block = _spread(w, v, hot, blocks)
            order = np.lexsort((doc, w, block))
            w, v, doc, block = w[order], v[order], doc[order], block[order]
            cuts = np.searchsorted(block, np.arange(blocks + 1))
            train = rows["train"].to_numpy(bool)
            out = []
            for b in range(blocks):
                s, e = cuts[b], cuts[b + 1]
                if s == e:
                    continue
                at = np.flatnonzero(np.concatenate(([True], w[s + 1 : e] != w[s : e - 1])))
                counts = np.diff(np.append(at, e - s))
                short = np.ascontiguousarray(v[s:e]).view(np.uint8).reshape(-1, 8)[:, :ID_BYTES].tobytes()
                step = np.diff(doc[s:e], prepend=0).astype(np.int32)
                words = pack(np.diff(w[s:e][at], prepend=np.uint64(0))), pack(counts.astype(np.uint32))
                out.append((b, batch, *words, short, pack(step), np.packbits(train).tobytes(), None))
            if out:
                k = batch % len(out)
                out[k] = (*out[k][:-1], pack(np.stack((rows["id"].to_numpy(np.int64), rows["nameless"].to_numpy(np.int64)))))
            yield pd.DataFrame(out, columns=["block", "batch", "words", "counts", "before", "doc", "train", "ids"])

    return run


def _decoded(frame: pd.DataFrame, blocks: int, part: int) -> tuple[np.ndarray, ...]:
    """Second word, first word, document and training flag of the bigrams in one part of a block.

    Documents are numbered over the batches of the block, in the order of the rows.
    """
    w, v, doc, train, base = [], [], [], [], 0
    for r in frame.itertuples(index=False):
        words, counts = np.cumsum(unpack(r.words, np.uint64), dtype=np.uint64), unpack(r.counts, np.uint32)
        chosen = words // np.uint64(blocks) % np.uint64(PARTS) == part
        flags = np.unpackbits(np.frombuffer(r.train, np.uint8)).astype(bool)
        if chosen.any():
            inside = np.repeat(chosen, counts)
            w.append(np.repeat(words[chosen], counts[chosen]))
            wide = np.zeros((len(w[-1]), 8), np.uint8)
            wide[:, :ID_BYTES] = np.frombuffer(r.before, np.uint8).reshape(-1, ID_BYTES)[inside]
            v.append(wide.view(np.uint64).ravel())
            own = np.cumsum(unpack(r.doc, np.int32), dtype=np.int64)[inside]
            train.append(flags[own])
            doc.append(own + base)
        base += len(flags)
    if not w:
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(0, np.int64), np.zeros(0, bool)
    w, v, doc, train = map(np.concatenate, (w, v, doc, train))
    order = np.lexsort((v, w))
    return w[order], v[order], doc[order], train[order]


def _added(keys: list[np.ndarray], tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the columns of the tables added up by key."""
    known, place = np.unique(np.concatenate(keys), return_inverse=True)
    rows = np.concatenate(tables, axis=1)
    return known, np.stack([np.bincount(place, row, len(known)) for row in rows])


def _counted(blocks: int, hot: np.ndarray, hot_counts: np.ndarray) -> Callable:
    """Rows of the four kinds from all bigrams of a block."""
    kinds = DISCOUNTED + 1

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = [(0, -1, r.batch, r.ids, None, None, None) for r in frame.itertuples(index=False) if r.ids is not None]
        present, shares, names, stats, lost_v, lost_doc = [], [], [], [], [], []
        ranks, distinct = np.zeros(DISCOUNTED + 3, np.int64), 0
        for part in range(PARTS):
            w, v, doc, train = _decoded(frame, blocks, part)
            if not len(w):
                continue
            new_w = np.concatenate(([True], w[1:] != w[:-1]))
            new_pair = new_w.copy()
            new_pair[1:] |= v[1:] != v[:-1]
            at_w, at_pair = np.flatnonzero(new_w), np.flatnonzero(new_pair)
            c_w = np.add.reduceat(train, at_w, dtype=np.int64)
            c_pair = np.add.reduceat(train, at_pair, dtype=np.int64)
            is_hot = np.isin(w[at_w], hot)
            if is_hot.any():
                c_w[is_hot] = hot_counts[np.searchsorted(hot, w[at_w][is_hot])]
            distinct += int(np.count_nonzero(c_w[~is_hot]))
            ranks += np.bincount(np.minimum(c_pair, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
            cw = np.repeat(c_w, np.diff(np.append(at_w, len(w))))
            r = np.repeat(c_pair, np.diff(np.append(at_pair, len(w))))
            seen = r > 0
            # Documents: what their tokens add, but for discounts and backoff weights.
            log_w = np.log10(cw + ADDED)
            value = np.where(seen, np.log10(np.where(r > DISCOUNTED, r - EPSILON, np.maximum(r, 1))), log_w)
            value -= np.where((cw > 0) & (w != END), np.log10(np.maximum(cw, 1)), 0)
            known, place = np.unique(doc, return_inverse=True)
            n = len(known)
            present.append(known)
            shares.append(
                np.stack(
                    [np.bincount(place, log_w, n), np.bincount(place, value, n)]
                    + [np.bincount(place, minlength=n), np.bincount(place, cw > 0, n), np.bincount(place, ~seen, n)]
                    + [np.bincount(place, r == k, n) for k in range(1, kinds)]
                )
            )
            # Contexts: per v its count, the unigram counts of its followers, its followers by count.
            kept = np.flatnonzero(c_pair > 0)
            kept = kept[np.argsort(v[at_pair][kept], kind="stable")]
            if len(kept):
                pv, pc = v[at_pair][kept], c_pair[kept]
                edge = np.flatnonzero(np.concatenate(([True], pv[1:] != pv[:-1])))
                names.append(pv[edge])
                stats.append(
                    np.stack(
                        [np.add.reduceat(pc, edge), np.add.reduceat(cw[at_pair][kept], edge)]
                        + [np.add.reduceat(np.minimum(pc, kinds) == k, edge, dtype=np.int64) for k in range(1, kinds + 1)]
                    )
                )
            lost_v.append(v[~seen])
            lost_doc.append(doc[~seen])
        sizes = [len(x) * 8 for x in frame["train"]]
        firsts = np.cumsum([0, *sizes])
        batches = frame["batch"].to_numpy(np.int64)
        docs, table = _added(present, shares)
        cuts = np.searchsorted(docs, firsts)
        for k, batch in enumerate(batches):
            s, e = cuts[k], cuts[k + 1]
            if s < e:
                index = (docs[s:e] - firsts[k]).astype(np.uint32)
                out.append((0, -1, batch, None, pack(index), pack(table[2:, s:e].astype(np.uint32)), pack(table[:2, s:e])))
        if names:
            contexts, table = _added(names, stats)
            home = (contexts % np.uint64(blocks)).astype(np.int64)
            for b in np.unique(home):
                own = home == b
                packed = pack(np.diff(contexts[own], prepend=np.uint64(0))), pack(table[:, own].astype(np.int64))
                out.append((1, int(b), -1, *packed, None, None))
        # Unseen bigrams, for the weights of their contexts.
        v, doc = np.concatenate(lost_v), np.concatenate(lost_doc)
        home = (v % np.uint64(blocks)).astype(np.int64)
        order = np.lexsort((doc, home))
        v, doc, home = v[order], doc[order], home[order]
        of = np.searchsorted(firsts, doc, side="right") - 1
        for b in np.unique(home):
            own = slice(*np.searchsorted(home, (b, b + 1)))
            index = (doc[own] - firsts[of[own]]).astype(np.uint32)
            out.append((2, int(b), -1, pack(v[own]), pack(batches[of[own]]), pack(index), None))
        out.append((3, -1, -1, pack(ranks), pack(np.array([distinct], np.int64)), None, None))
        return pd.DataFrame(out, columns=["kind", "block", "batch", "a", "b", "c", "d"])

    return run


def discounts(ranks: np.ndarray) -> np.ndarray:
    """d(1) to d(DISCOUNTED) from the numbers of bigrams seen 0, 1, 2, ... times.

    Where Good and Turing's are not between 0 and 1 (few data), an absolute discount takes their place.
    """
    n = ranks.astype(float)
    r = np.arange(1, DISCOUNTED + 1)
    if n[1 : DISCOUNTED + 2].min() > 0:
        cut = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
        d = ((r + 1) * n[2 : DISCOUNTED + 2] / (r * n[1 : DISCOUNTED + 1]) - cut) / (1 - cut) if cut < 1 else r * 0.0
        if d.min() > 0 and d.max() < 1:
            return d
    less = n[1] / (n[1] + 2 * n[2]) if n[1] > 0 and n[2] > 0 else 0.5
    return (r - less) / r


def _weighted(d: np.ndarray, norm: float) -> Callable:
    """Per batch: what the backoff weights of unseen bigrams add to its documents."""
    freed = np.append((1 - d) * np.arange(1, DISCOUNTED + 1), EPSILON)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = frame[frame["kind"] == 1]
        names = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in parts["a"]]
        if names:
            known, table = _added(names, [unpack(x, np.int64).reshape(DISCOUNTED + 3, -1) for x in parts["b"]])
            followers = table[2:].sum(axis=0)
            left = freed @ table[2:]
            beyond = 1 - (table[1] + ADDED * followers) / norm
            # Takes back the count of the context and puts its weight in place: c(v) * alpha(v).
            add = np.log10(left) - np.log10(beyond)
        else:
            known, add = np.zeros(0, np.uint64), np.zeros(0)
        lost = frame[frame["kind"] == 2]
        out = []
        if len(lost):
            v = np.concatenate([unpack(x, np.uint64) for x in lost["a"]])
            batch = np.concatenate([unpack(x, np.int64) for x in lost["b"]])
            doc = np.concatenate([unpack(x, np.uint32) for x in lost["c"]])
            at = np.minimum(np.searchsorted(known, v), max(len(known) - 1, 0))
            value = np.where(known[at] == v, add[at], 0.0) if len(known) else np.zeros(len(v))
            order = np.lexsort((doc, batch))
            batch, doc, value = batch[order], doc[order], value[order]
            new = np.flatnonzero(np.concatenate(([True], (batch[1:] != batch[:-1]) | (doc[1:] != doc[:-1]))))
            total, batch, doc = np.add.reduceat(value, new), batch[new], doc[new]
            for b in np.unique(batch):
                own = slice(*np.searchsorted(batch, (b, b + 1)))
                out.append((0, -1, b, None, pack(doc[own]), None, pack(total[own])))
        return pd.DataFrame(out, columns=["kind", "block", "batch", "a", "b", "c", "d"])

    return run


def _scores(d: np.ndarray, total: int, docs: int, norm: float) -> Callable:
    logs = np.log10(d)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ids, nameless = unpack(frame["a"].dropna().iloc[0], np.int64).reshape(2, -1)
        whole, real = np.zeros((3 + DISCOUNTED, len(ids)), np.int64), np.zeros((2, len(ids)))
        for r in frame.itertuples(index=False):
            if r.b is None:
                continue
            at = unpack(r.b, np.uint32)
            if r.c is not None:
                whole[:, at] += unpack(r.c, np.uint32).reshape(-1, len(at))
                real[:, at] += unpack(r.d, np.float64).reshape(2, -1)
            else:
                real[1, at] += unpack(r.d, np.float64)
        # Every first token has the start as context, seen `docs` times.
        start = math.log10(docs) if docs else 0.0
        return pd.DataFrame(
            {
                "id": ids,
                "nameless": nameless.astype(bool),
                "n_tokens": whole[0],
                "n_known": whole[1],
                "train_tokens": total,
                "base_score": real[0] - whole[0] * math.log10(norm),
                "score": real[1] + logs @ whole[3:] - whole[2] * math.log10(norm) - start,
            }
        )

    return run


def score_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of `docs`.

    `docs` has doc_id and text; the model learns from all rows but those of the held-out fold. Null
    texts are empty and have the end token alone; a null id is folded like an empty one. Repeated
    rows count as often as they occur. Without training rows all words are unknown and both scores
    are uniform. An empty table gives an empty result.
    """
    text_batches(docs.sparkSession, 1000)
    text = F.coalesce("text", F.lit("")).cast("binary")
    held = crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("nameless"),
        text.alias("text"),
        (~held).alias("train"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    sample = rows.select("id", "text").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("text")
    often = _frequent(sample, 1 / (4 * max(blocks, 8)))
    counts = {
        bytes(r["w"]): (r["n"], r["docs"])
        for r in rows.select("text", "train").mapInPandas(_totals(often), "w binary, n long, docs long")
        .groupBy("w").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).collect()
    }
    total, n_docs = counts.pop(b"", (0, 0))
    pairs = sorted((word_id(w), c) for w, (c, _) in counts.items())
    hot = np.array([w for w, _ in pairs], np.uint64)
    hot_counts = np.array([c for _, c in pairs], np.int64)
    bigrams = rows.mapInPandas(
        _bigrams(blocks, hot),
        "block int, batch long, words binary, counts binary, before binary, doc binary, train binary, ids binary",
    )
    tables = staged(bigrams.groupBy("block").applyInPandas(_counted(blocks, hot, hot_counts), MARKS), "katz-tables")
    # One short row per block.
    ranks, distinct = np.zeros(DISCOUNTED + 3, np.int64), int(np.count_nonzero(hot_counts))
    for r in tables.where("kind = 3").select("a", "b").collect():
        ranks += unpack(bytes(r["a"]), np.int64)
        distinct += int(unpack(bytes(r["b"]), np.int64)[0])
    d, norm = discounts(ranks), total + ADDED * (distinct + 1)
    weights = tables.where("kind IN (1, 2)").groupBy("block").applyInPandas(_weighted(d, norm), MARKS)
    scored = (
        tables.where("kind = 0")
        .union(weights)
        .groupBy("batch")
        .applyInPandas(
            _scores(d, total, n_docs, norm),
            "id long, nameless boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
    named = scored.withColumn("doc_id", F.when(~F.col("nameless"), F.col("id")))
    return named.select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
