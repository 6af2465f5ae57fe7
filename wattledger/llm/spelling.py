"""Spelling variants by an index of variable-length grams.

Words are padded with an end mark. From every start a gram grows from two characters until it is in
few enough words, up to five; the grams that are in too many are the dictionary that says where to go
on. A gram depends on its own characters only, so an edit at one place spoils just the grams across
that place: the most such grams of a word are its bound. Of its G grams at least G minus the bound
are in every near word too. All but so many of its rarest grams can thus be left out: the lists of
the bound + 1 rarest are merged, by gram, place and length, and every pair in them is verified by its
edit distance inside the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import ascii_lower, small, staged

# Fixed values of the contract.
LETTER_RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
NOISE = 31

END = "$"
SHORTEST_GRAM = 2
LONGEST_GRAM = 5
#: A gram that is in more words grows by one character.
FREQUENT = 100


def words_of(docs: DataFrame) -> DataFrame:
    """word, n: the contract's words of `docs` (doc_id, text) with their occurrences.

    Runs of letters are lower-cased (A-Z only) and lose one character if the crc32 of
    `<doc_id>:<run>` says so; a null id counts as an empty string, null and empty texts have no words.
    """
    # A shorter run cannot become a word.
    runs = F.regexp_extract_all(F.col("text"), F.lit(LETTER_RUN.replace("+", f"{{{LEAST_LENGTH},}}")), F.lit(0))
    run = F.col("run")
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), run).cast("binary"))
    # Noise is rare, so most occurrences are added up before anything else is done with them.
    at = F.when(h % NOISE == 0, (h % F.length(run)).cast("int")).otherwise(-1)
    forms = each.select("id", ascii_lower(run).alias("run")).select("run", at.alias("at")).groupBy("run", "at").count()
    cut = F.concat(F.substring(run, F.lit(1), F.col("at")), F.substring(run, F.col("at") + 2, F.length(run)))
    words = forms.select(F.when(F.col("at") < 0, run).otherwise(cut).alias("word"), "count")
    return (
        words.where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.sum("count").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def frequent_grams(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """gram: those from the shortest length on that occur more than `frequent` times in `words`.

    A gram whose beginning is not frequent isn't either, so each length only looks at the grams
    that go on from the length before.
    """
    padded = F.concat("word", F.lit(END))
    kept = None
    for size in range(SHORTEST_GRAM, LONGEST_GRAM):
        starts = F.sequence(F.lit(1), F.length(padded) - size + 1)
        grams = words.where(F.length(padded) >= size).select(
            F.explode(F.transform(starts, lambda p: F.substring(padded, p, F.lit(size)))).alias("gram")
        )
        if kept is not None:
            before = kept.withColumnRenamed("gram", "start")
            grams = grams.join(before, F.substring("gram", 1, size - 1) == F.col("start"), "left_semi")
        level = grams.groupBy("gram").count().where(F.col("count") > frequent).select("gram")
        level = small(level, "frequent-grams")
        kept = level if kept is None else kept.union(level)
    return kept


def decomposed(words: DataFrame, grams: DataFrame) -> DataFrame:
    """word, at, gram, n_grams: the variable-length gram from every start (from 0) of every word."""
    padded = F.concat("word", F.lit(END))
    starts = F.sequence(F.lit(0), F.length(padded) - SHORTEST_GRAM)
    rows = words.select("word", F.length(padded).alias("size"), F.posexplode(starts).alias("_", "at"))
    growing = rows.select("word", "size", "at", F.lit(SHORTEST_GRAM).alias("length"))
    gram = F.substring(F.concat("word", F.lit(END)), F.col("at") + 1, F.col("length"))
    for _ in range(SHORTEST_GRAM, LONGEST_GRAM):
        named = growing.withColumn("gram", gram)
        known = grams.withColumnRenamed("gram", "frequent_gram")
        goes_on = F.col("frequent_gram").isNotNull() & (F.col("at") + F.col("length") < F.col("size"))
        growing = named.join(known, F.col("gram") == F.col("frequent_gram"), "left").select(
            "word", "size", "at", (F.col("length") + F.when(goes_on, 1).otherwise(0)).alias("length")
        )
    return growing.select("word", "at", gram.alias("gram"))


def _bound(grams: Column) -> Column:
    """The most grams across any one character (the end mark included)."""
    places = F.sequence(F.lit(0), F.size(grams))

    def across(i: Column) -> Column:
        return F.size(F.filter(grams, lambda g: (g["at"] <= i) & (i < g["at"] + F.length(g["gram"]))))

    return F.array_max(F.transform(places, across))


def rare_grams(parts: DataFrame) -> DataFrame:
    """word, gram, at: the bound + 1 rarest grams of every word."""
    lists = parts.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    sized = parts.join(lists, "gram")
    entry = F.struct("held", "gram", "at")
    whole = sized.groupBy("word").agg(F.array_sort(F.collect_list(entry)).alias("grams"))
    rare = F.slice("grams", F.lit(1), _bound(F.col("grams")) + 1)
    return whole.select("word", F.inline(rare)).select("word", "gram", "at")


def near_pairs(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """u, v: every pair of words (column word, distinct, two characters at least) one edit apart, once."""
    parts = staged(decomposed(words, frequent_grams(words, frequent)), "grams")
    rare = staged(rare_grams(parts), "rare-grams")
    size = F.length("word")
    entries = rare.select(F.col("word").alias("v"), F.xxhash64("gram", "at", size).alias("key"))
    # The rarest gram that the edit spares is where it was, or one further on in a longer word.
    places = F.array(*(F.xxhash64("gram", F.col("at") + a, size + d) for d, a in ((0, 0), (1, 0), (1, 1))))
    probes = rare.select(F.col("word").alias("u"), F.explode(places).alias("key"))
    ordered = (F.length("u") < F.length("v")) | (F.col("u") < F.col("v"))
    near = ordered & (F.levenshtein(F.col("u"), F.col("v"), 1) == 1)
    return probes.alias("p").join(entries.alias("e"), (F.col("p.key") == F.col("e.key")) & near).select("u", "v").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of `forms` (word, form): every step doubles the way until nothing moves."""
    now = staged(forms.select("word", F.col("form").alias("root")).where("root IS NOT NULL"), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(
            now.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """word, form, root, n, n_near, form_n of `words` (word, n; distinct words)."""
    pairs = staged(near_pairs(words.select("word"), frequent), "near-words")
    both = pairs.union(pairs.select("v", "u"))
    named = both.join(words.select(F.col("word").alias("v"), F.col("n").alias("v_n")), "v")
    best = named.groupBy("u").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("v_n")).alias("less"), F.col("v").alias("word"))).alias("best")
    )
    taken = -F.col("best")["less"] >= RATIO * F.col("n")
    formed = staged(
        words.join(best.withColumnRenamed("u", "word"), "word", "left").select(
            "word",
            F.when(taken, F.col("best")["word"]).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("best")["less"]).alias("form_n"),
        ),
        "forms",
    )
    return formed.join(_roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `docs` (doc_id, text).

    A word's form is its near word of most occurrences (ties: the first by code points) if it has ten
    times as many. Repeated rows count again; an empty table gives an empty result.
    """
    return variants(staged(words_of(docs), "words"))


def normalised(docs: DataFrame, forms: DataFrame) -> DataFrame:
    """doc_id, word, root, n: occurrences per document of the words that `forms` gives another root.

    Words are the lower-cased runs of letters of the text as it stands.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(LETTER_RUN.replace("+", f"{{{LEAST_LENGTH},}}")), F.lit(0))
    used = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", ascii_lower(F.col("run")).alias("word"))
    other = forms.where("root != word").select("word", "root")
    return used.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n")).join(other, "word").select("doc_id", "word", "root", "n")
