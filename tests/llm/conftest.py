import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, score double, text_sha256 string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(20_000))
    near = " ".join(f"tok{i}" for i in range(60))
    rows = [(1, "Hello World, this is a text.", "en", "s1"), (2, "hello world, THIS is a text.", "en", "s1"),
            (3, "", "en", "s2"), (4, None, None, None), (None, "no id here at all", "en", "s2"), (5, None, "de", "s2"),
            (6, long, "en", "s1"), (7, long + " end", "en", None), (8, near, "en", "s3"), (9, near.replace("tok30", "other"), "en", "s3"),
            (8, near, "en", "s3"), (10, " \t\n ", "fr", "s3"), (11, "12 34 -- !!", None, "s1"), (12, "Éa é́ 中文 字 x", "fr", "s2"),
            (13, "one two", "en", "s1"), (14, "one two", "en", "s1"), (15, "x" * 30_000, "en", "s2")]
    return spark.createDataFrame([(a, b, c, d, None, 7, None, "clash") for a, b, c, d in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


@pytest.fixture(scope="session")
def mid(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


def mod(n, r):
    from repflow.llm.tables import crc_mod

    return crc_mod(F.col("doc_id"), n) == r
