"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a word target. Whole epochs of the source come first; the rest of the target is
filled in the order of exponential keys -ln(u) / weight, so that a document of twice the quality
weight is twice as likely to come next. u is a hash of the document's id: reruns agree.

Prefix sums never order a whole source in one task. Keys are cut into buckets by a monotone map,
bucket totals are added up over a small table, and only the rows of one bucket are ordered
together, so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattledger.llm.common import n_words, staged

# Weights of the sources in code point order, repeating, and the limit of epochs.
SOURCE_WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3

#: Rows that share an ordered bucket, on average.
BUCKET_ROWS = 2_000
#: Weight of a document that is all symbols, against 1 for one without any.
LEAST_WEIGHT = 0.1
SEED = "mix-1"


def quality_weight(text: Column) -> Column:
    """Between LEAST_WEIGHT and 1; falls with the share of symbols among the words."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0))
    share = symbols / F.greatest(n_words(text), F.lit(1))
    return F.greatest(F.lit(LEAST_WEIGHT), F.lit(1.0) - share)


def uniform(doc_id: Column, seed: str) -> Column:
    """A number within (0, 1) from 52 bits of an MD5 of seed and id; a null id counts as empty."""
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS, most: int = MOST_EPOCHS
) -> DataFrame:
    """source, source_size, n_docs, target: shares of the total by weight, at most `most` times the size.

    The excess of sources at their limit is shared by weight among the others until none is above.
    With sources in the order of limit / weight, the limited ones are a prefix; the level of the
    others is what is left, over the weight that is left. One row per source goes through here.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    ranked = by_source.withColumn("place", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int")
    )
    limited = ranked.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("stop"))
    order = W.orderBy(F.col("stop") / F.col("weight"), "place")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    level = limited.select(
        "*",
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
    )
    # The first source below its limit fixes the level; those ahead of it stop at their limit.
    free = F.col("stop") >= F.col("level") * F.col("weight")
    shared = level.withColumn("shared", F.min(F.when(free, F.struct(F.col("stop") / F.col("weight"), "place", "level"))).over(everything)["level"])
    target = F.least(F.col("stop").cast("double"), F.col("shared") * F.col("weight"))
    return shared.select("source", "source_size", "n_docs", F.coalesce(target, F.lit(0.0)).alias("target"))


def sample(sizes: DataFrame, targets: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, taken for rows of doc_id, source, size, weight.

    A source with target t and size s gives floor(t / s) whole epochs. The rest takes documents in
    key order; the document that crosses the rest is taken if that ends nearer to the target.
    Equal keys are ordered by id and size; rows equal in all are interchangeable.
    """
    plan = targets.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.greatest(F.lit(1.0), F.ceil(F.col("n_docs") / bucket_rows)).alias("buckets"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0)
        .alias("epochs"),
    )
    keyed = sizes.withColumn("key", -F.log(uniform(F.col("doc_id"), SEED)) / F.col("weight"))
    placed = keyed.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "key",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
        F.floor((1 - F.exp(-F.col("key"))) * F.col("buckets")).alias("bucket"),
    )
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("of"),
        F.col("bucket").alias("at"),
        F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("before_bucket"),
    )
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    within = placed.withColumn(
        "before_row",
        F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
    )
    matched = within.join(
        offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))
    )
    # Taken while the middle of the document lies before the end of the rest.
    start = F.col("before_bucket") + F.col("before_row")
    chosen = (start + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    taken = F.col("size") * (F.col("epochs") + F.when(chosen & (F.col("epochs") < MOST_EPOCHS), 1).otherwise(0))
    return matched.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        n_words(F.col("text")).alias("size"),
        quality_weight(F.col("text")).alias("weight"),
    )


def mix_sources(docs: DataFrame) -> DataFrame:
    """Words that the mix takes of every document of `docs` (doc_id, text, source).

    A null text has size 0 and is taken 0 times; null sources are one source, last in order; an
    empty table gives an empty result; repeated rows are documents of their own.
    """
    sizes = staged(document_sizes(docs), "mix-sizes")
    return sample(sizes, staged(source_targets(sizes), "mix-targets"))
