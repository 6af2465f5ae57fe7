"""Quality rules whose cutoffs carry a proven limit on false rejection.

Each rule rejects a document whose measure exceeds a cutoff. Cutoffs are chosen per stratum on
labelled holdout documents: a cutoff is certified if the exact (Clopper-Pearson) upper bound on the
share of good documents it rejects is at most the limit. Strata and rules are corrected by
Bonferroni; within one stratum and rule the cutoffs are tested in a fixed order, from the one that
rejects least, up to the first failure, which needs no further correction. The limit is divided
over the rules, so their union keeps it. A stratum without enough labels certifies nothing and
rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattledger.functions.once import with_computed
from wattledger.llm.common import small, staged, words

#: Share of good documents that all rules together may reject in a stratum, and the error level.
LIMIT = 0.02
ERROR = 0.05

#: Cutoffs of each rule, from the strictest to reject to the loosest.
CUTOFFS = {
    "symbols_per_word": tuple(2.0 * 0.8**i for i in range(32)),
    "repeated_lines": tuple(0.96 - 0.03 * i for i in range(31)),
    "repeated_words": tuple(0.5 - 0.015 * i for i in range(32)),
    "word_length": tuple(24.0 - 0.5 * i for i in range(32)),
}


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, less the skipped factors."""
    z = x + 8.0
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    skipped = sum((F.log(x + float(i)) for i in range(1, 8)), F.log(x))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - skipped


def binomial_at_most(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X binomial(n, p), 0 <= k <= n, 0 < p < 1; summed from k downwards."""
    k, n = k.cast("double"), n.cast("double")
    at_k = F.exp(
        log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(p) + (n - k) * F.log(1 - p)
    )
    total = F.aggregate(
        F.sequence(F.lit(0), k.cast("int")),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] * (k - i) * (1 - p) / ((n - k + i + 1) * p)).alias("term"),
            (acc["sum"] + acc["term"]).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return at_k * total


def measures(docs: DataFrame) -> DataFrame:
    """Counts over every whole text; a null text has no words.

    Three-word windows are compared by 64-bit hash within one document. Only documents with a
    repeated window order their windows; nothing is shuffled.
    """
    base = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"), F.coalesce("text", F.lit("")).alias("text"))
    split = with_computed(
        base,
        w=words(F.col("text")),
        lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    n = F.size("w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = with_computed(
        split,
        n_words=n.cast("long"),
        word_chars=F.length(F.array_join("w", "")).cast("long"),
        n_symbols=F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        h=windows,
    ).drop("text", "w", "lines")
    ordered = with_computed(
        hashed,
        s=F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop("h")
    again = F.filter(
        "s",
        lambda x, j: (x["h"] == F.get("s", j - 1)["h"]) | (x["h"] == F.get("s", j + 1)["h"]),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    )
    return ordered.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.size(covered).cast("long").alias("n_repeat_words"), "n_lines",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / n,
        "word_length": F.col("word_chars") / n,
    }


def _spared(value: Column, cuts: tuple[float, ...]) -> Column:
    """How many of the cutoffs, which fall, are not exceeded by the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut >= value))


def certified_cutoffs(
    measured: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR
) -> DataFrame:
    """stratum, rule, cutoff for every stratum and rule that certifies one.

    `labels` has doc_id and quality; only rows of quality 1 speak about false rejection. A document
    labelled more than once counts once, with its lowest label. Good documents that the base
    already fails are left out: their rejection is not the cutoffs' doing.
    """
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    held = measured.where(~base_failed()).join(good.select("doc_id"), "doc_id", "left_semi")
    passed = F.array(
        *(
            F.struct(
                F.lit(name).alias("rule"),
                _spared(rule_values()[name], cuts).alias("spared"),
            )
            for name, cuts in CUTOFFS.items()
        )
    )
    # spared: how many of the ordered cutoffs let the document pass; cutoff i rejects it if i >= spared.
    counts = held.select("stratum", F.inline(passed)).groupBy("stratum", "rule", "spared").count()
    # Every cutoff needs a row, also where no document changes sides there.
    grid = counts.groupBy("stratum", "rule").agg(
        F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("spared", "count"))).alias("at")
    )
    cuts = F.create_map(*(x for name, c in CUTOFFS.items() for x in (F.lit(name), F.array(*map(F.lit, c)))))
    tested = grid.withColumn("tests", F.count(F.lit(1)).over(W.partitionBy(F.lit(1))))
    steps = tested.select("stratum", "rule", "n", "tests", "at", F.posexplode(cuts[F.col("rule")]).alias("step", "cutoff"))
    rejected = steps.select(
        "stratum", "rule", "n", "tests", "step", "cutoff",
        F.aggregate(
            F.sequence(F.lit(0), F.col("step")), F.lit(0).cast("long"),
            lambda a, i: a + F.coalesce(F.try_element_at("at", i), F.lit(0)),
        ).alias("k"),
    )
    p = F.lit(limit / len(CUTOFFS))
    judged = rejected.withColumn(
        "holds", binomial_at_most(F.col("k"), F.col("n"), p) <= error / F.col("tests")
    )
    in_order = W.partitionBy("stratum", "rule").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    unbroken = judged.withColumn("unbroken", F.min("holds").over(in_order)).where("unbroken")
    return unbroken.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def apply_rules(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Every measured document with base_failed and kept."""
    by_stratum = small(
        cutoffs.groupBy(F.col("stratum").alias("of")).agg(
            F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts")
        ),
        "rule-cutoffs",
    )
    joined = measured.join(by_stratum, F.col("stratum") == F.col("of"), "left")
    over = F.lit(False)
    for name, value in rule_values().items():
        over = over | F.coalesce(value > F.try_element_at("cuts", F.lit(name)), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Verdict on every row of `docs` (doc_id, text, lang) under cutoffs certified on `labels`.

    A null language is a stratum of its own. Null or empty texts fail the base. Repeated rows are
    judged alike. Empty tables give an empty result.
    """
    measured = staged(measures(docs), "rule-measures")
    return apply_rules(measured, certified_cutoffs(measured, labels))
