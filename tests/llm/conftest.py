import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
#: columns that carry the names the operators use inside
CLASHES = ("size", "shard", "slot", "f", "w", "a", "b", "r", "n", "g", "at", "pos", "code", "cell", "hot", "word", "line", "y", "x", "kept", "good")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, white space alone, further columns."""
    long = " ".join(f"word{i % 977}x{i % 89}" for i in range(30_000))
    block = "\n".join(f"this is line number {k} of a block that several documents share word for word" for k in range(8))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, long), (5, "The same short text."), (6, "The same short text."), (6, "The same short text."),
            (None, "a text without an id"), (None, None), (7, "x" * 50_000), (8, block), (9, "before it.\n" + block + "\nafter it."),
            (9, "another text with the same id"), (10, "é ü 日本語 \U0001f600 " * 40), (11, " " * 3000), (12, "\n\n" + block + "\n\n\ntail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
