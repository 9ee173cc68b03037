import os

import pytest

SF_DIR = os.environ.get("FOOTINGS_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    rows = [
        (1, "one two three four five six seven eight", "en", "a", 39),
        (1, "one two three four five six seven eight", "en", "a", 39),
        (2, "", "en", "b", 0),
        (3, None, None, None, None),
        (None, "a null id with password = hunter2secret", "en", "a", 10),
        (None, None, None, None, None),
        (4, "é" * 30_000, "fr", None, 30_000),
        (5, "word " * 40_000, "en", "b", 200_000),
        (6, " \n\t ", "en", "", 4),
        (7, "日本語 🎉 \u0000 x", "ja", "c", 11),
        (7, "same id, other text", "en", "c", 19),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("score", "label", "size", "taken", "copies", "node", "class", "hex", "assign", "linked", "key", "ids",
                 "shard", "depth", "target", "text_a", "n_tokens", "_order", "_key", "_first", "_scope", "row", "quality"):
        from pyspark.sql import functions as F

        docs = docs.withColumn(name, F.lit(7))
    return docs


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
