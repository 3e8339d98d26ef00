from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def small(spark):
    return {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels", "pages", "benchmark")}


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and extra columns with clashing names."""
    long = " ".join(f"word{i % 977} apache license" for i in range(30_000))
    text = "The quick brown fox jumps over the lazy dog near the river bank on a sunny day in May"
    rows = [
        (1, text, "en", "a", 10), (1, text, "en", "a", 10), (1, text, "en", "a", 10), (2, text, "en", "b", 10),
        (3, None, "en", "a", 0), (4, "", "en", None, 0), (5, "   \n\t ", None, "b", 6), (6, long, "en", "a", None),
        (None, text + " x", "en", "a", 5), (None, None, None, None, None), (7, "123 456", "de", "é", 7),
        (8, "password = 'abcdEFGH12345678' 😀 " + text, "en", "z", 3), (9, "a b", "en", "z", 3), (-10, "a\x00b", "en", "z", 3),
    ]
    docs = spark.createDataFrame(rows, COLUMNS)
    clashing = ["words", "row", "doc", "fp", "start", "size", "_part", "part", "label", "c0", "kept", "score", "hash", "n_words", "copy", "length"]
    return docs.select("*", *[F.lit("x").alias(c) for c in clashing])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
