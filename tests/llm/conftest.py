import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

# Names that operators use for columns of their own.
CLASHES = ("row", "key", "h", "s", "w", "n", "fp", "spans", "size", "label", "text_", "covered", "leader", "score")

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)


@pytest.fixture(scope="session")
def tables(spark):
    return {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels", "benchmark", "pages")}


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    prose = " ".join(f"word{i % 97} and{i % 31} so" for i in range(400))
    extra = ("x",) * len(CLASHES)
    rows = [
        (1, "", "en", "a", 0),
        (2, None, "en", "a", None),
        (None, None, None, None, None),
        (None, prose, None, None, 3),
        (3, prose, "en", None, 3),
        (3, prose, "en", None, 3),
        (3, prose + " another end", "en", "b", 3),
        (4, "password = abcdef0123456789\n\n\n   \n", "de", "b", 3),
        (5, "\n\n", "de", "b", 3),
        (6, prose + " \U0001f600 été " + prose, "fr", "b", 3),
        (7, "the quick brown fox. " * 15000, "en", "c", 3),
        (8, "\x00\x01 \x7f tab\tnew\nline\r\x0b\x0c", "en", "c", 3),
        (9, "x" * 100_000, "en", "c", 3),
    ]
    return [r + extra for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENT)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame(
        [(1, 0, 0), (3, 1, 0), (3, 0, 0), (None, 1, 0), (6, None, None), (7, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="session")
def odd_items(spark):
    return spark.createDataFrame(
        [(1, "word0 and0 so"), (2, None), (None, "word0 and0"), (3, ""), (3, "nowhere to be found"), (4, "SO so")],
        "item_id long, text string",
    )
