"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; fingerprints within 3 bits agree in one of two 32-bit segments up to one
bit. Every distinct fingerprint is in a table under each segment's value; it probes the table with
its own values and the 32 values one bit away, and candidates are verified over all 64 bits inside
the join. Copies share a fingerprint and are looked up once. Components run over the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import boxed, staged, text_batches, unboxed
from wattledger.llm.components import components

# Fixed values of the contract.
SHINGLE = 3
SEED = 42
DISTANCE = 3

SEGMENT_BITS = 32
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit fingerprint; 0 for a text without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < SHINGLE:
        shingles: Iterator[bytes] = iter([b" ".join(w)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(SHINGLE))))
        n = len(w) - SHINGLE + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), ">u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def fingerprints(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def links(prints: DataFrame) -> DataFrame:
    """u, v for distinct fingerprints (column fp) that differ in at most DISTANCE bits."""
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    # The segment's number stands above its value in one key.
    keys = F.array(low, high.bitwiseOR(F.lit(1 << SEGMENT_BITS)))
    entries = prints.select(F.col("fp").alias("v"), F.explode(keys).alias("key"))
    ball = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(SEGMENT_BITS)))
    probes = prints.select(F.col("fp").alias("u"), F.explode(keys).alias("own")).select(
        "u", F.explode(F.transform(ball, lambda b: F.col("own").bitwiseXOR(b))).alias("key")
    )
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)
    return probes.alias("p").join(entries.alias("e"), (F.col("p.key") == F.col("e.key")) & near).select("u", "v")


def grouped(marked: DataFrame) -> DataFrame:
    """The rows of `marked` (doc_id, fp and others) with component_id and leader.

    component_id is the smallest id reachable (null only if the whole group has null ids); leader is
    the smallest fingerprint of the group and names it in any case.
    """
    prints = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(prints.select("fp")))
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("leader")
    )
    ids = rooted.groupBy("leader").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "leader").join(ids, "leader")
    return marked.join(named, "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of `docs` (doc_id, text).

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows stay. An
    empty table gives an empty result.
    """
    text_batches(docs.sparkSession)
    marked = staged(docs.select("doc_id", fingerprints("text").alias("fp")), "fingerprints")
    return grouped(marked).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One whole row of `docs` per group: the one of smallest id, null ids last.

    Of rows with the same id the one with the smallest hash stays; rows equal in all are one.
    """
    text_batches(docs.sparkSession)
    rows = boxed(docs).withColumn("h", F.xxhash64("row"))
    marked = staged(
        rows.select(F.col("row")["doc_id"].alias("doc_id"), "h", fingerprints("text").alias("fp")), "fingerprints"
    )
    copies = grouped(marked).groupBy("leader", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    chosen = copies.groupBy("leader").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h", "n")).alias("best")
    )
    best = staged(chosen.select(F.col("best")["h"].alias("h"), F.col("best")["n"].alias("n")), "kept-rows")
    # The rows are dealt out at any size; a broadcast of the kept hashes would only suit small inputs.
    kept = rows.join(best.hint("shuffle_hash"), "h")
    # Only rows that are there more than once have to meet each other.
    again = kept.where("n > 1").groupBy("h").agg(F.first("row").alias("row"))
    return unboxed(kept.where("n = 1").select("row").union(again.select("row")), docs)
