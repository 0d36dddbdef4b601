from __future__ import annotations

import pytest

from shelfcast.llm import common as C

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    C.prepare(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def small_docs(spark):
    return C.table(spark, SMALL, "documents")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and white-space texts, a very long text, repeated rows, repeated ids, odd characters, clashing columns."""
    long_text = " ".join(f"word{i % 977}x{i % 89}" for i in range(60_000))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, "   \n\t ", None), (4, "one two", "c"), (5, "One  TWO\nthree four five six\n\nseven", "d"),
        (6, long_text, "e"), (7, long_text, "e"), (8, "same row " * 40, "f"), (8, "same row " * 40, "f"), (9, "same id first text " * 30, "g"),
        (9, "same id other text " * 30, "g"), (None, "a text without an id " * 20, "h"), (None, None, None),
        (10, "Ωmega naïve 日本語 😀   x y \x01 z " * 15, "i"), (11, "tail space ", "j"), (12, "\nhead break", "k"),
    ]
    df = spark.createDataFrame([(i, t, x, x, 7, x) for i, t, x in rows],
                               "doc_id long, text string, fingerprint string, n_words string, score int, _id string")
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("doc_id = -1")
