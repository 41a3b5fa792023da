"""Fixtures of rows that every operator must take: test modules import them."""
import pytest

#: Null, empty, tied, repeated and very long texts, and columns whose names clash with inner ones.
SCHEMA = "doc_id long, text string, h string, node long, key string, n long, id string"


def edge_rows():
    long = "word ninety token passage other " * 30_000
    return [(1, None, "x", 1, "k", 0, "i"), (2, "", "x", 1, "k", 0, "i"), (3, "same text here", "x", 1, "k", 0, "i"),
            (4, "same text here", "y", 1, "k", 0, "i"), (4, "same text here", "y", 1, "k", 0, "i"),
            (None, "same text here", "y", None, None, None, None), (None, None, None, None, None, None, None),
            (5, long, "x", 2, "k", 0, "i"), (6, " \t\n", "x", 2, "k", 0, "i"), (7, "é ü 漢字 \U0001f600", "x", 2, "k", 0, "i")]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
