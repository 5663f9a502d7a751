"""Fixtures and texts for the tests of this folder (imported, so that the outer conftest stays the only one)."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use within.
CLASHES = ["score", "shard", "uid", "copies", "component", "row", "key", "of", "digest", "copy_no", "shuffle_key", "rate", "pack",
           "vid", "label", "passage", "start", "size", "part", "law", "rank", "block", "host", "path", "rule", "payload", "first_id", "page"]


def prose(seed: int, words: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(words))


def clashing(df):
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHES if c not in df.columns])


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated ids and rows, clashing extra columns."""
    long_text = prose(1, 30_000)
    rows = [(1, prose(2, 120), "en", "a", 1), (2, prose(2, 120), "en", "a", 1), (2, prose(2, 120), "en", "a", 1),
            (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n ", "en", "b", 3), (6, long_text, "de", None, 9),
            (7, long_text + " tail", "de", "c", 9), (None, prose(3, 80), "en", "a", 2), (None, None, None, None, None),
            (8, "one two", "en", "a", 7), (9, prose(4, 60) + " é ß 漢字 " + prose(5, 60), "fr", "c", 1), (9, prose(6, 50), "fr", "c", 1)]
    return clashing(spark.createDataFrame(rows, DOCS))


@pytest.fixture(scope="session")
def no_docs(spark):
    return clashing(spark.createDataFrame([], DOCS))
