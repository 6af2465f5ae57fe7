"""URL filter: rules first, then a ratio of two character language models.

Rules name a host and a path; they also label the pages that they fit, and these pages train one
variable-order Markov model of accepted and one of rejected URLs. The models see the whole URL, with
its scheme, query and fragment; host and path are for the rules alone. Both models share a table with
a row per context of 0 to ORDER characters. Witten-Bell smoothing mixes the orders: a context that was
followed by many different characters trusts the shorter context more; below order 0 lies a
uniform distribution. A URL without a rule is allowed if its log-likelihood difference per
character reaches a threshold calibrated on labelled pages that trained neither model.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattledger.functions.once import with_computed
from wattledger.llm.common import BROADCAST_ROWS, ascii_lower, crc_fold, staged

# The rules.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: Longest context, size of the uniform alphabet, one of so many folds that calibrates.
ORDER = 4
ALPHABET = 256
FOLDS = 5
START = "\x02"
#: URLs that a task scores.
STRINGS_PER_TASK = 2_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def string_of(url: Column) -> Column:
    """What the models see: the whole URL with its host in lower case; null is empty."""
    whole, host = F.coalesce(url, F.lit("")), host_of(url)
    before = F.regexp_extract(whole, r"(?s)^.*?://", 0)
    return F.concat(before, host, F.substr(whole, F.length(before) + F.length(host) + 1))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null. Equal lengths: the first by text."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(ordered):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def characters(strings: DataFrame, order: int = ORDER) -> DataFrame:
    """A row per character of column s: its ch and the contexts c0 to c<order> before it."""
    padded = F.concat(F.lit(START * order), F.col("s"))
    at = strings.select("*", F.posexplode(F.split("s", "")).alias("i", "ch")).where("ch != ''")
    contexts = (
        F.substring(padded, F.col("i") + 1 + order - k, F.lit(k)).alias(f"c{k}") for k in range(order + 1)
    )
    return at.select(*strings.columns, "ch", *contexts)


def train(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """ctx, and per class counts of the next character (map), their sum and their number.

    `labelled` has s and label (allow or block).
    """
    seen = characters(labelled.select("s", "label"), order)
    pairs = seen.select("label", "ch", F.explode(F.array(*(f"c{k}" for k in range(order + 1)))).alias("ctx"))
    counts = pairs.groupBy("label", "ctx", "ch").agg(F.count(F.lit(1)).alias("n"))

    def of(label: str, name: str) -> list[Column]:
        own = F.col("label") == label
        return [
            F.map_from_entries(F.collect_list(F.when(own, F.struct("ch", "n")))).alias(f"{name}_next"),
            F.sum(F.when(own, F.col("n")).otherwise(0)).alias(f"{name}_sum"),
            F.sum(own.cast("long")).alias(f"{name}_kinds"),
        ]

    return counts.groupBy("ctx").agg(*of("allow", "a"), *of("block", "b"))


def score(strings: DataFrame, model: DataFrame, order: int = ORDER, most: int = BROADCAST_ROWS) -> DataFrame:
    """s, score for every distinct s: mean over its characters of ln P(allow) - ln P(block).

    An empty string has no row. Contexts are joined by their length, shortest first, and marked for a
    broadcast while they are counted to be at most `most` in all: the short ones are few, and every
    string has them.
    """
    sizes = dict(model.groupBy(F.length("ctx")).count().collect())
    held = 0
    distinct = strings.select("s").distinct()
    # Characters are many times the bytes of the strings, so that small partitions must not merge.
    parts = max(1, math.ceil(strings.count() / STRINGS_PER_TASK))
    rows = characters(distinct.repartition(parts, "s"), order)
    p = {name: F.lit(1.0 / ALPHABET) for name in "ab"}
    for k in range(order + 1):
        part = model.where(F.length("ctx") == k).select(*(F.col(c).alias(f"{c}_{k}") for c in model.columns))
        held += sizes.get(k, 0)
        if held <= most:
            part = F.broadcast(part)
        rows = rows.join(part, F.col(f"c{k}") == F.col(f"ctx_{k}"), "left")
        step = {}
        for name in "ab":
            n = F.coalesce(F.try_element_at(f"{name}_next_{k}", F.col("ch")), F.lit(0))
            total = F.coalesce(f"{name}_sum_{k}", F.lit(0))
            kinds = F.coalesce(f"{name}_kinds_{k}", F.lit(0))
            mixed = (n + kinds * F.col(f"p{name}")) / (total + kinds)
            step[f"p{name}"] = F.when(total > 0, mixed).otherwise(F.col(f"p{name}"))
        if k == 0:
            rows = rows.withColumns({f"p{name}": p[name] for name in "ab"})
        rows = rows.withColumns(step).drop(*(f"{c}_{k}" for c in model.columns), f"c{k}")
    return rows.groupBy("s").agg(F.avg(F.log("pa") - F.log("pb")).alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row with t, the score (in steps of 0.01) that separates allow from block best.

    `scored` has label and score. Best is the highest sum of the shares judged right; ties go to
    the step nearest 0, the lower of two. Without rows of both labels t is 0.
    """
    steps = scored.groupBy(F.floor(F.greatest(F.least(F.col("score"), F.lit(20.0)), F.lit(-20.0)) * 100).alias("step")).agg(
        F.sum((F.col("label") == "allow").cast("long")).alias("a"),
        F.sum((F.col("label") == "block").cast("long")).alias("b"),
    )
    # At most 4001 rows.
    order = W.partitionBy(F.lit(1)).orderBy("step")
    below = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    right = steps.select(
        "step",
        (F.sum("a").over(everything) - F.coalesce(F.sum("a").over(below), F.lit(0))).alias("a_above"),
        F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b_below"),
        F.sum("a").over(everything).alias("a"),
        F.sum("b").over(everything).alias("b"),
    ).where("a > 0 AND b > 0")
    best = F.struct(
        (F.col("a_above") / F.col("a") + F.col("b_below") / F.col("b")).alias("right"),
        (-F.abs("step")).alias("near"),
        (-F.col("step")).alias("low"),
    )
    return right.agg(F.coalesce(-F.max(best)["low"] / 100.0, F.lit(0.0)).alias("t"))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of `pages` (page_id, url).

    A null URL, or one without "://", has an empty host and path; the latter is scored as it stands, a
    null or empty one scores 0. Repeated rows are judged alike. Without labelled pages every score is 0
    and all pages without a rule are allowed.
    """
    url = F.col("url")
    read = with_computed(pages.select("page_id", "url"), host=host_of(url), path=path_of(url), s=string_of(url)).drop("url")
    ruled = staged(
        with_computed(read, found=rule_of(F.col("host"), F.col("path"), rules)).select(
            "page_id", "host", "path", "found.rule", F.col("found.verdict").alias("label"), "s",
        ),
        "url-rules",
    )
    known = ruled.where(F.col("label").isNotNull()).select(
        "s", "label", (crc_fold(F.col("page_id"), FOLDS) == 0).alias("calibrates")
    )
    model = staged(train(known.where(~F.col("calibrates"))), "url-model")
    scores = staged(score(ruled, model), "url-scores")
    held = known.where("calibrates").select("s", "label").join(scores, "s")
    t = threshold(held).first()[0]
    judged = ruled.join(scores.withColumnRenamed("s", "of"), F.col("s") == F.col("of"), "left")
    scored = F.coalesce("score", F.lit(0.0))
    own = F.when(scored >= F.lit(t), "allow").otherwise("block")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("label", own).alias("verdict"), scored.alias("score")
    )
