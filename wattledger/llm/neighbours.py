"""Nearest neighbours by multi-index hashing of learned binary codes.

Largest inner product is made least distance: candidates get one more coordinate that lifts all of
them to the largest norm, queries are scaled to that norm. The signs of learned rotations (iterative
quantisation on a bounded sample) are the codes. The Hamming radius is measured, not guessed: for a
bounded sample of queries the true neighbours among all rows are found first, and the radius holds
the wanted share of them.

Codes and queries are dealt into blocks. A task has one block of codes and one of queries; it indexes
every 8-bit substring of its codes and probes each index with the values near the query's own. Where
the allowances of the substrings add up to the radius as the pigeonhole principle wants it, no code
within the radius is missed. Codes are verified over all bits, and the original vectors rank what is
left. Queries with fewer codes within the radius than wanted neighbours go through again with the
whole code as radius.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import staged

# Fixed values of the contract.
QUERY_STEP = 20
NEIGHBOURS = 20

#: Bits of one rotation, rotations, bits of an indexed substring.
ROTATION_BITS = 64
ROTATIONS = 2
SUBSTRING = 8
#: Rows the rotations are learned from, and queries the radius is measured with.
FIT_ROWS = 4000
FIT_QUERIES = 200
FIT_STEPS = 20
#: Share of the measured neighbours that the radius holds.
WANTED = 0.97
#: Rows of a block of codes and of a block of queries.
CODE_ROWS = 10_000
QUERY_ROWS = 50_000
#: Pairs that a task handles at once.
PAIRS = 1 << 20

CODED = "vec_id long, vec binary, code binary, probe binary"
FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Model:
    """Learned codes of vectors of one dimension."""

    scale: float
    norm: float
    middle: np.ndarray
    turn: np.ndarray

    def _signs(self, lifted: np.ndarray) -> np.ndarray:
        return np.packbits((lifted - self.middle) @ self.turn > 0, axis=1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        rest = np.sqrt(np.maximum(self.norm**2 - (x**2).sum(axis=1), 0.0))
        return self._signs(np.column_stack([x, rest]))

    def probes(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        length = np.sqrt((x**2).sum(axis=1, keepdims=True))
        length[length == 0] = 1.0
        return self._signs(np.column_stack([x * (self.norm / length), np.zeros(len(x))]))


def learn(sample: np.ndarray, scale: float, norm: float) -> Model:
    """Rotations that move the sample close to the corners of a cube."""
    x = sample / scale
    lifted = np.column_stack([x, np.sqrt(np.maximum(norm**2 - (x**2).sum(axis=1), 0.0))])
    middle = lifted.mean(axis=0)
    lifted, random = lifted - middle, np.random.default_rng(7)
    size = lifted.shape[1]
    turns = []
    for _ in range(ROTATIONS):
        if size >= ROTATION_BITS:
            base = np.linalg.svd(lifted, full_matrices=True)[2][:ROTATION_BITS].T if len(lifted) >= size else np.eye(size)[:, :ROTATION_BITS]
        else:
            base = np.linalg.qr(random.normal(size=(ROTATION_BITS, size)))[0].T
        flat = lifted @ base
        turn = np.linalg.qr(random.normal(size=(ROTATION_BITS, ROTATION_BITS)))[0]
        for _ in range(FIT_STEPS):
            u, _, v = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
            turn = u @ v
        turns.append(base @ turn)
    return Model(scale, norm, middle, np.hstack(turns))


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added in one order whatever the batch."""
    return (x * y).sum(axis=1)


def allowances(radius: int, parts: int) -> list[int]:
    """Bits by which each substring may differ: they add up to radius - parts + 1 (-1: not probed)."""
    whole, more = divmod(radius + 1, parts)
    return [whole] * more + [whole - 1] * (parts - more)


def balls(radius: int, parts: int) -> list[np.ndarray]:
    """For each substring, all values with at most as many bits set as it is allowed."""
    values = np.arange(1 << SUBSTRING, dtype=np.uint8)
    return [values[np.bitwise_count(values) <= bits] for bits in allowances(radius, parts)]


class Index:
    """Tables of a block of codes, one per substring: rows in order of their value."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.radius = radius
        self.words = codes.view(np.uint64)
        self.orders = [np.argsort(p, kind="stable").astype(np.int32) for p in codes.T]
        self.balls = balls(radius, len(self.orders))
        self.starts = [np.searchsorted(p[o], np.arange((1 << SUBSTRING) + 1)).astype(np.int32) for p, o in zip(codes.T, self.orders)]

    def within(self, code: np.ndarray) -> np.ndarray:
        """Rows of the block whose codes differ from `code` in at most `radius` bits."""
        hit = np.zeros(len(self.words), bool)
        for value, order, starts, ball in zip(code, self.orders, self.starts, self.balls):
            near = ball ^ value
            first = starts[near]
            count = starts[near.astype(np.int32) + 1] - first
            full = count > 0
            first, count = first[full], count[full]
            ahead = np.repeat(first - (np.cumsum(count) - count), count)
            hit[order[ahead + np.arange(len(ahead), dtype=np.int32)]] = True
        rows = np.flatnonzero(hit)
        far = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1)
        return rows[far <= self.radius]


def _matrix(vectors: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1)


def _best(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the `most` highest scores, ties to the smaller id."""
    if len(score) > most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        chosen = np.flatnonzero(score >= least)
    else:
        chosen = np.arange(len(score))
    return chosen[np.lexsort((ids[chosen], -score[chosen]))][:most]


def _search(kind: str, radius: int, most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            index = Index(_matrix(rows["code"], "u1"), radius)
            x, ids = _matrix(rows["vec"], kind), rows["vec_id"].to_numpy(np.int64)
            probes, q = _matrix(queries["probe"], "u1"), _matrix(queries["vec"], kind)
            for query, probe, vector in zip(queries["vec_id"].to_numpy(np.int64), probes, q):
                near = index.within(probe)
                near = near[ids[near] != query]
                score = np.concatenate(
                    [scores(x[near[i : i + PAIRS // 16]].astype("f8"), vector.astype("f8")[None]) for i in range(0, len(near), PAIRS // 16)]
                    or [np.empty(0)]
                )
                best = _best(score, ids[near], most)
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def _valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that take part, one row per vec_id."""
    x = F.col("embedding")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL").where(finite & F.exists(x, lambda v: v != 0))
    return usable.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _coded(rows: DataFrame, model: Model, kind: str, step: int) -> DataFrame:
    """vec_id, vec (bytes), code and, for queries, probe."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["embedding"].to_list()).astype(kind)
            asks = batch["vec_id"].to_numpy() % step == 0
            probes = [p.tobytes() if a else None for p, a in zip(model.probes(x.astype("f8")), asks)]
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "vec": [v.tobytes() for v in x],
                    "code": [c.tobytes() for c in model.codes(x.astype("f8"))],
                    "probe": probes,
                }
            )

    return rows.mapInPandas(code, CODED)


def _top(found: DataFrame, most: int) -> DataFrame:
    """The best `most` of each query, as rows (query_id, rank, vec_id, score)."""
    best = F.struct((-F.col("score")).alias("less"), "vec_id")
    ordered = F.slice(F.array_sort(F.collect_list(best)), 1, most)
    ranked = found.groupBy("query_id").agg(ordered.alias("best")).select("query_id", F.posexplode("best"))
    return ranked.select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col")["vec_id"].alias("vec_id"), (-F.col("col")["less"]).alias("score")
    )


def measured_radius(coded: DataFrame, queries: DataFrame, kind: str, most: int, wanted: float = WANTED) -> int:
    """The Hamming radius that holds the wanted share of the true neighbours of sampled queries."""
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_QUERIES).select("vec_id", "vec", "probe").toPandas()
    if not len(asked):
        return 0
    q = _matrix(asked["vec"], kind).astype("f8")
    probes, names = _matrix(asked["probe"], "u1").view(np.uint64), asked["vec_id"].to_numpy(np.int64)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, ids = _matrix(batch["vec"], kind).astype("f8"), batch["vec_id"].to_numpy(np.int64)
            codes, score = _matrix(batch["code"], "u1").view(np.uint64), q @ x.T
            for i, name in enumerate(names):
                others = np.flatnonzero(ids != name)
                best = others[_best(score[i, others], ids[others], most)]
                far = np.bitwise_count(codes[best] ^ probes[i]).sum(axis=1)
                yield pd.DataFrame({"query_id": name, "less": -score[i, best], "vec_id": ids[best], "far": far.astype(np.int64)})

    each = coded.select("vec_id", "vec", "code").mapInPandas(exact, "query_id long, less double, vec_id long, far long")
    nearest = F.slice(F.array_sort(F.collect_list(F.struct("less", "vec_id", "far"))), 1, most)
    far = each.groupBy("query_id").agg(nearest.alias("best")).select(F.explode("best.far").alias("far"))
    counts = sorted((r["far"], r["count"]) for r in far.groupBy("far").count().collect())
    left = wanted * sum(n for _, n in counts)
    for distance, n in counts:
        left -= n
        if left <= 0:
            return distance
    return 0


def _searched(coded: DataFrame, queries: DataFrame, blocks: tuple[int, int], kind: str, radius: int, most: int) -> DataFrame:
    n_rows, n_queries = blocks
    code_block = F.pmod(F.xxhash64("vec_id"), F.lit(n_rows)).cast("int")
    # Other bits of the hash, so that the blocks of queries are even whatever the number of blocks.
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_queries)).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))
    asking = queries.select("vec_id", "vec", "probe", everywhere.alias("c"), query_block.alias("q"))
    each = F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))
    held = coded.select("vec_id", "vec", "code", code_block.alias("c"), each.alias("q"))
    pairs = asking.groupBy("c", "q").cogroup(held.groupBy("c", "q"))
    return _top(pairs.applyInPandas(_search(kind, radius, most), FOUND), most)


def nearest(
    vectors: DataFrame, most: int = NEIGHBOURS, step: int = QUERY_STEP, code_rows: int = CODE_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: the `most` nearest found of every query of `vectors`.

    Queries are the rows whose vec_id is divisible by `step`. Null vec_ids and vectors that are null,
    zero, or hold null or non-finite components take no part, and neither do those of another length
    than most (ties: the longer). A vec_id is one vector: of repeated rows the least stays. Equal
    scores go to the smaller vec_id. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    rows = staged(_valid(vectors), "vectors")
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("embedding") == sizes["size"])
    scale = rows.agg(F.max(F.array_max(F.transform("embedding", lambda v: F.abs(v.cast("double")))))).first()[0]
    square = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + (v.cast("double") / scale) * (v.cast("double") / scale))
    norm = float(np.sqrt(rows.agg(F.max(square)).first()[0]))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("embedding").toPandas()
    model = learn(np.stack(sample["embedding"].to_list()).astype("f8"), scale, norm)
    coded = staged(_coded(rows, model, kind, step), "codes")
    queries = coded.where("probe IS NOT NULL")
    blocks = (-(-sizes["count"] // code_rows), max(1, -(-queries.count() // query_rows)))
    radius = measured_radius(coded, queries, kind, most)
    found = staged(_searched(coded, queries, blocks, kind, radius, most), "neighbours")
    # Whoever found too few looks at everything.
    full = min(most, sizes["count"] - 1)
    filled = found.groupBy("query_id").count().where(F.col("count") >= full).select(F.col("query_id").alias("vec_id"))
    poor = staged(queries.join(filled, "vec_id", "left_anti"), "poor-queries")
    n_poor = poor.count()
    if not n_poor:
        return found
    again = _searched(coded, poor, (blocks[0], -(-n_poor // query_rows)), kind, 8 * len(model.turn[0]), most)
    good = found.join(filled.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
    return good.unionByName(again)
