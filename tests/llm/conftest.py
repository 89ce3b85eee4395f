import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))

#: Nulls in every column, empty and blank texts, ties, repeated rows, one very long text.
ODD_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (2, "The quick brown fox  jumps over the lazy dog again and again", "en", "a", 10),
    (3, None, None, None, None),
    (None, "a null id", "en", None, 3),
    (None, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \t\n", "de", "b", 3),
    (6, "ein kurzer text", "de", "b", 5),
    (7, "0123 456 !!", None, "c", 1),
    (8, LONG, "en", "c", len(LONG)),
    (9, LONG + " tail", "en", "c", len(LONG)),
    (10, "été à l'œuvre — ça va? 日本語 \U0001f600\x00\x1c end", "fr", "d", 7),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns called like those that operators add or use inside."""
    names = ["kept", "score", "hits", "spans", "_row", "component_id", "class_id", "bucket", "label", "size", "shard", "h", "_c0", "_c1", "item_ids", "predicted"]
    return odd.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
