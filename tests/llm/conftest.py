"""Small documents that hold the awkward cases."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, digest string, component string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"word{i % 977} thing{i % 13}" for i in range(20_000))
    rows = [
        (1, "the same text of several words", "en", "a"), (2, "the same text of several words", "en", "a"), (2, "the same text of several words", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, "  \n\t ", "de", "b"), (6, long, "en", "a"), (7, long + " end", "en", None), (None, "no key here at all", "fr", "c"),
        (8, "12 34 !?", "es", "c"), (9, "word", None, "c"), (10, "WORD", "en", "d"), (11, "é ü \U0001f600 x", "fr", "d"),
    ]
    return spark.createDataFrame([(i, t, l, s, len(t or ""), 7, "x", "y") for i, t, l, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
