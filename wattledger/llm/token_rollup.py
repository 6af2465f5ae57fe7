"""Token counts as delta-maintained rollups.

Totals of documents and tokens by source, language and tokenizer version are never recounted. A
batch of changes is turned into signed rows: an insert adds its count, a delete takes it back, a
revision takes the old count back and adds the new one. The batch adds them up before anything is
written, so its delta has one row per group. Committing is idempotent: the delta replaces the
folder of its batch and becomes visible by a commit row written after it; a batch that already has
one is skipped. Totals are the sum over committed deltas, or over the last compacted base and the
deltas that it doesn't hold.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import WORD, staged
from wattledger.session import work_folder
from wattledger.sources.files import Folder

# Patterns of one token, by tokenizer version.
TOKENIZERS = {"words-1": WORD, "digits-1": r"[0-9]|[^0-9\x20\x09-\x0D]+"}

KEYS = ("source", "lang", "tokenizer")
DELTA = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS]
    + [T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType())]
)


def count_tokens(text: Column, tokenizer: str) -> Column:
    pattern = F.lit(TOKENIZERS[tokenizer])
    return F.coalesce(F.regexp_count(text, pattern), F.lit(0)).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens: a row per document and tokenizer version."""
    each = F.array(
        *(
            F.struct(F.lit(name).alias("tokenizer"), count_tokens(F.col("text"), name).alias("n_tokens"))
            for name in TOKENIZERS
        )
    )
    return docs.select("doc_id", "source", "lang", F.inline(each))


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows of changes with the keys and `before` and `after` counts.

    A null `before` is an insert, a null `after` a delete; with both it is a revision. A row
    without either changes nothing.
    """
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").cast("long").alias("count")),
        F.struct(F.lit(1).alias("sign"), F.col("after").cast("long").alias("count")),
    )
    return changes.select(*KEYS, F.inline(sides)).where("count IS NOT NULL")


class Rollup:
    """The rollup below one folder: deltas/, commits/ and bases/."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._folder = Folder(spark, self._path)

    def committed(self) -> list[str]:
        return sorted(n.removeprefix("batch=") for n in self._folder.names("commits/batch=*") if self._folder.exists(f"commits/{n}/_SUCCESS"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it was applied before."""
        if self._folder.exists(f"commits/batch={batch}/_SUCCESS"):
            return False
        delta = signed(changes).groupBy(*KEYS).agg(
            F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("count")).alias("n_tokens")
        )
        delta.write.mode("overwrite").parquet(f"{self._path}/deltas/batch={batch}")
        self._spark.range(0).write.mode("overwrite").parquet(f"{self._path}/commits/batch={batch}")
        return True

    def _bases(self) -> list[str]:
        return sorted(n for n in self._folder.names("bases/v*") if self._folder.exists(f"bases/{n}/held/_SUCCESS"))

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches in it."""
        bases = self._bases()
        if not bases:
            return None, set()
        base = f"{self._path}/bases/{bases[-1]}"
        return base, {r[0] for r in self._spark.read.parquet(f"{base}/held").collect()}

    def _sum(self, base: str | None, batches: Iterable[str]) -> DataFrame:
        parts = [f"{base}/totals"] * bool(base) + [f"{self._path}/deltas/batch={b}" for b in batches]
        rows = self._spark.read.schema(DELTA).parquet(*parts) if parts else self._spark.createDataFrame([], DELTA)
        return (
            rows.groupBy(*KEYS)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs != 0 OR n_tokens != 0")
        )

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups without documents or tokens are gone."""
        base, held = self._base()
        return self._sum(base, sorted(set(self.committed()) - held))

    def compact(self) -> None:
        """Fold the committed deltas into a new base; readers use it once its list of batches is written.

        Both the totals and the list come from one look at the commits, so that a batch which lands
        meanwhile is in neither and stays a delta.
        """
        name = f"{self._path}/bases/v{len(self._bases()):08d}"
        base, held = self._base()
        new = sorted(set(self.committed()) - held)
        self._sum(base, new).write.mode("overwrite").parquet(f"{name}/totals")
        listed = self._spark.createDataFrame([(b,) for b in sorted(held.union(new))], "batch string")
        listed.write.mode("overwrite").parquet(f"{name}/held")


def _changed(docs: DataFrame) -> tuple[Rollup, DataFrame]:
    """The rollup of `docs` after the batches of corpus_rollup, and the rows behind them.

    The rows, one per document and tokenizer version, have the keys, n_tokens, `copy` and `short`.
    """
    spark = docs.sparkSession
    counts = staged(
        docs.select("doc_id", "source", "lang", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"),
                    *(count_tokens(F.col("text"), t).alias(t) for t in TOKENIZERS)),
        "token-counts",
    )
    # The first of its text: the smallest id, and of equal ids the first by source and language.
    first = counts.groupBy("digest").agg(F.min(F.struct("doc_id", "source", "lang")).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = first.where("n > 1").select("digest", "first")
    marked = counts.join(repeated, "digest", "left").withColumn(
        "copy", F.coalesce(F.struct("doc_id", "source", "lang") > F.col("first"), F.lit(False))
    )
    each = F.array(*(F.struct(F.lit(t).alias("tokenizer"), F.col(f"`{t}`").alias("n_tokens")) for t in TOKENIZERS))
    rows = staged(
        marked.select("source", "lang", (F.col("`words-1`") < 5).alias("short"), "copy", F.inline(each)), "token-changes"
    )
    none = F.lit(None).cast("long")
    inserted = rows.select(*KEYS, none.alias("before"), F.col("n_tokens").alias("after"))
    now = F.when(F.col("copy"), F.lit(0).cast("long")).otherwise(F.col("n_tokens"))
    rollup = Rollup(spark, work_folder(spark, "token-rollup"))
    rollup.commit("load-1", inserted)
    rollup.commit("revise-1", rows.where("copy").select(*KEYS, F.col("n_tokens").alias("before"), now.alias("after")))
    rollup.commit("load-1", inserted)
    rollup.compact()
    rollup.commit("delete-1", rows.where("short").select(*KEYS, now.alias("before"), none.alias("after")))
    return rollup, rows


def corpus_rollup(docs: DataFrame) -> DataFrame:
    """Totals of `docs` (doc_id, text, source, lang) after four batches.

    All counts are inserted; copies of a text of smaller doc_id are revised to 0 tokens, since
    their text is counted already; a replay of the first batch changes nothing; documents of fewer
    than five words are deleted. Null texts have 0 tokens, null keys are groups of their own, rows
    of equal doc_id and text are copies of each other. Totals over all rows are in corpus_totals().
    """
    return _changed(docs)[0].totals()


def _restored(rollup: Rollup, rows: DataFrame) -> DataFrame:
    """Totals after two more batches, which take the revisions and deletes of _changed() back."""
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    rollup.commit("insert-2", rows.where("short").select(*KEYS, none.alias("before"), F.col("n_tokens").alias("after")))
    revised = rows.where("copy AND NOT short")
    rollup.commit("revise-2", revised.select(*KEYS, zero.alias("before"), F.col("n_tokens").alias("after")))
    return rollup.totals()


def corpus_totals(docs: DataFrame) -> DataFrame:
    """Totals over all rows of `docs` (doc_id, text, source, lang).

    Two batches follow those of corpus_rollup: its deleted documents are inserted again, and the
    copies left are revised back to their own counts.
    """
    return _restored(*_changed(docs))


def corpus_states(docs: DataFrame) -> DataFrame:
    """The totals of both states of one rollup, with the column `state`.

    'changed' is that of corpus_rollup, 'all' that of corpus_totals.
    """
    rollup, rows = _changed(docs)
    changed = rollup.totals().select(F.lit("changed").alias("state"), "*")
    return changed.unionByName(_restored(rollup, rows).select(F.lit("all").alias("state"), "*"))
