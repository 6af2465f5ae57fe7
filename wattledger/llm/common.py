"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.session import work_folder

# The word patterns of the contracts.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Rows that a table may have to be offered for a broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def boxed(docs: DataFrame) -> DataFrame:
    """Rows as one struct `row` beside their text, so that added columns cannot clash with theirs."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("text"))


def unboxed(rows: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of `docs` from `row`, with another text if one is given."""
    kept = (F.col("row")[c] for c in docs.columns)
    return rows.select(
        *(text.alias(c) if c == "text" and text is not None else v.alias(c) for c, v in zip(docs.columns, kept, strict=True))
    )


def text_batches(spark: SparkSession, rows: int = 500) -> None:
    """Hand Python at most this many texts at once; the session's default suits narrow rows."""
    if int(spark.conf.get(ARROW_ROWS)) > rows:
        spark.conf.set(ARROW_ROWS, str(rows))


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared work folder and read them back.

    What follows reads files that outlive executors, and nothing before them runs twice. Shuffle
    files of the write go when it is done, since nothing else uses them.
    """
    spark = rows.sparkSession
    path = work_folder(spark, purpose)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(rows.schema).parquet(path)


def small(rows: DataFrame, purpose: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Stage rows and mark them for a broadcast only if they are counted to be at most `most`."""
    kept = staged(rows, purpose)
    return F.broadcast(kept) if kept.count() <= most else kept


def words(text: Column) -> Column:
    """Words between ASCII white space; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    plain = F.translate(text, upper, upper.lower())
    return F.when(text.rlike("[A-Z]"), plain).otherwise(text)


def crc_fold(doc_id: Column, n: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
