from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two three four five one two three four five", "b"), (4, "one two three four five one two three four five", "b"),
    (5, "é! É, İstanbul <|endoftext|> don't 漢字 Licensed under CC BY 4.0.", "b"), (None, "no id here", "c"), (6, "x" * 300_000, "c"), (7, "same line\nsame line\n\n\nother", "c"), (8, "word " * 60_000, "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names might clash."""
    rows = [(i, t, s, "s", 1, 2, 3) for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, id long, code long, _d long").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
