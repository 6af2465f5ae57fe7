"""Benchmark decontamination: windows of test words looked up in a broadcast hash set.

Every whole text is cut into words once. A window of ten words has one of the text's 6-word grams that
start at every fifth word, so only these are hashed and probe the set of grams of benchmark windows.
Where one is found, the windows around it are hashed where the words are and probe the set of windows;
a hit is verified word by word on the spot, so neither texts nor windows are shuffled. Only hits and one
row per document reach the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.once import with_computed
from wattledger.llm.common import ascii_lower, boxed, small, staged, unboxed

# Characters between item words (after lower-casing), and the words of a window.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10

#: Distinct benchmark windows, and distinct grams of them, that may be broadcast; beyond it the set is
#: joined by shuffle.
BROADCAST_WINDOWS = 2_000_000


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _stride(length: Column) -> Column:
    """Distance of the grams of a text that are looked up for windows of `length` words."""
    return F.greatest(F.floor(length / 2).cast("int"), F.lit(1))


def _gram(length: Column) -> Column:
    """Words of a gram: so many that every window holds just one that starts at a multiple of the stride."""
    return length - _stride(length) + 1


def _probes(w: Column, length: int) -> Column:
    """Hashes of the grams that decide whether windows of `length` words may occur."""
    gram = _gram(F.lit(length))
    last = F.size(w) - gram
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last, _stride(F.lit(length))),
            lambda i: F.struct(
                F.lit(length).alias("len"), i.alias("at"), F.xxhash64(F.slice(w, i + 1, gram)).alias("hash")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<len:int,at:int,hash:bigint>>"))


def _around(w: Column, length: Column, at: Column) -> Column:
    """The windows of `length` words that hold the gram found at a word, with their hashes."""
    first = F.greatest(at - _stride(length) + 1, F.lit(0))
    last = F.least(at, F.size(w) - length)
    return F.when(
        first <= last,
        F.transform(
            F.sequence(first, last),
            lambda i: F.struct(
                length.alias("len"), i.alias("at"), F.xxhash64(F.slice(w, i + 1, length)).alias("hash")
            ),
        ),
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """len, hash, words (space-joined) and the items of every distinct window of the test texts.

    An item with fewer words than a window is one window; one without words or id has none.
    """
    items = with_computed(benchmark.select("item_id", "text"), w=item_words(F.col("text")))
    n = F.size("w")
    length = F.least(n, F.lit(window))
    parts = F.transform(
        F.sequence(F.lit(0), n - length), lambda i: F.slice("w", i + 1, length)
    )
    cut = items.where((n > 0) & F.col("item_id").isNotNull()).select(
        "item_id", length.alias("len"), F.explode(parts).alias("part")
    )
    return cut.groupBy("len", F.xxhash64("part").alias("hash"), F.array_join("part", " ").alias("words")).agg(
        F.collect_set(F.col("item_id").cast("string")).alias("items")
    )


def window_grams(windows: DataFrame) -> DataFrame:
    """len, hash of every distinct gram of the benchmark windows."""
    w, gram = F.split("words", " "), _gram(F.col("len"))
    starts = F.sequence(F.lit(0), F.col("len") - gram)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i + 1, gram)))
    return windows.select("len", F.explode(hashes).alias("hash")).distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, n_words, at, len, items: one row per verified hit, and one without a hit per document.

    `docs` has key and text.
    """
    test = staged(benchmark_windows(benchmark, window), "bench-windows")
    # At most `window` different lengths.
    lengths = sorted(r[0] for r in test.select("len").distinct().collect())
    known = test.select(
        "hash", F.col("len").alias("test_len"), F.col("words").alias("test_words"), "items"
    )
    if test.count() <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    grams = window_grams(test).withColumn("seen", F.lit(True))
    grams = small(grams, "bench-grams", BROADCAST_WINDOWS)
    cut = with_computed(docs.select("key", "text"), w=item_words(F.col("text"))).drop("text")
    # The first entry stands for the document itself.
    mark = F.array(F.struct(F.lit(0).alias("len"), F.lit(-1).alias("at"), F.lit(None).cast("long").alias("hash")))
    grammed = cut.select("key", "w", F.inline(F.concat(mark, *(_probes(F.col("w"), n) for n in lengths))))
    near = grammed.join(grams, ["len", "hash"], "left").where((F.col("at") < 0) | F.col("seen"))
    windows = F.when(F.col("at") < 0, mark).otherwise(_around(F.col("w"), F.col("len"), F.col("at")))
    # The outer form: Spark would test the arrays of the inner one for size below the join, for every gram.
    probes = near.select("key", "w", F.inline_outer(windows))
    found = probes.join(known, "hash", "left").where(
        (F.col("at") < 0)
        | (
            (F.col("len") == F.col("test_len"))
            & (F.array_join(F.slice("w", F.col("at") + 1, F.col("len")), " ") == F.col("test_words"))
        )
    )
    return found.select("key", F.when(F.col("at") < 0, F.size("w").cast("long")).alias("n_words"), "at", "len", "items")


def _covered() -> Column:
    hits = F.collect_list(F.when(F.col("at") >= 0, F.struct("at", "len")))
    return F.array_distinct(
        F.flatten(F.transform(hits, lambda x: F.sequence(x["at"], x["at"] + x["len"] - 1)))
    )


def per_document(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, n_words, n_rows (of the key), covered (hit word numbers), items (ids as sorted strings)."""
    return (
        find_hits(docs, benchmark, window)
        .groupBy("key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count("n_words").alias("n_rows"),
            _covered().alias("covered"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Digest per row of `docs` (doc_id, text).

    Rows of equal id and text are judged together and returned as often as they occur; null text
    has no words; an empty benchmark contaminates nothing.
    """
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("t")).alias("key"), "text")
    n_hit = F.size("covered").cast("long")
    return per_document(rows, benchmark, window).select(
        "key.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))),
    ).drop("col")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "document") -> DataFrame:
    """`docs` without contaminated documents, or without their hit spans (remove="span").

    A span goes with the separators that follow its words; other text stays as it is. Null texts and
    repeated rows stay as they are.
    """
    keyed = boxed(docs).withColumn("key", F.xxhash64("row"))
    found = per_document(keyed.select("key", "text"), benchmark)
    hit = small(found.where(F.size("covered") > 0).select("key", "covered"), "hits")
    if remove == "document":
        return unboxed(keyed.join(hit, "key", "left_anti"), docs)
    if remove != "span":
        raise ValueError(f"remove is 'document' or 'span', not {remove!r}")
    text = F.col("text")
    joined = with_computed(
        keyed.join(hit, "key", "left"),
        w=F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        gaps=F.split(text, WORD, -1),
    )
    kept = F.filter(F.transform("w", lambda x, i: i), lambda i: ~F.array_contains("covered", i))
    rebuilt = F.concat(
        F.get("gaps", F.lit(0)),
        F.array_join(F.transform(kept, lambda i: F.concat(F.get("w", i), F.get("gaps", i + 1))), ""),
    )
    return unboxed(joined, docs, F.when(F.size("covered") > 0, rebuilt).otherwise(text))
