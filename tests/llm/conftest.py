"""Rows that every operator must bear: nulls, empty and very long texts, ties, repeated rows."""

import pytest

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(20_000))
BASE = " ".join(f"tok{i}" for i in range(300))
DOCS = [
    (1, BASE, "en", "a", 1), (2, BASE, "en", "a", 1), (2, BASE, "en", "a", 1), (3, None, "en", "a", None), (4, "", None, None, 0),
    (5, LONG, "en", "b", 1), (None, "null id " + BASE, "en", "b", 1), (6, BASE + " extra", "en", "c", 1), (7, "two words", "xx", "c", 1),
    (8, "Ünïcode 日本語 😀 text\nline\nline", "de", "c", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
