"""Small document tables with the awkward cases every operator must take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, one
    long text, a hot text."""
    long_text = " ".join(f"word{i % 977} other{i % 31}" for i in range(40_000))
    rows = [(1, "Hello World", "en", "a", 11), (2, "hello world", "en", "b", 11),
            (3, "HELLO WORLD", None, None, None), (4, None, None, "a", None),
            (5, "", "en", None, 0), (6, " \t\n", "en", "b", 3), (None, "hello world", "en", "a", 11),
            (None, None, None, None, None), (7, "same row", "en", "c", 8),
            (7, "same row", "en", "c", 8), (8, "Ähre ähre", "de", "a", 9), (9, long_text, "en", "a", 1),
            (10, long_text + " end", "en", "b", 1)]
    rows += [(100 + i, "hot text of many copies", "en", "hot", 23) for i in range(60)]
    return frame(spark, rows)


@pytest.fixture()
def empty_docs(spark):
    return frame(spark, [])
