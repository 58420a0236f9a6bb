from __future__ import annotations

import pytest

# Columns whose names operators use themselves.
CLASH = (
    "n long, h1 long, id long, label string, own boolean, gone long, version long, repeated string, items string, spans string,"
    " n_words long, n_hit long, ranges string, lang string, doc_id_of string, first string, size long, x string, y int"
)


@pytest.fixture
def docs(spark):
    """A table of documents from ``(doc_id, text)`` rows, with other columns that are all null."""

    def make(rows, clash=False):
        schema = "doc_id long, text string" + (", " + CLASH if clash else "")
        width = len(schema.split(",")) - 2
        return spark.createDataFrame([(*r, *[None] * width) for r in rows], schema)

    return make


# Null key, null and empty texts, repeated rows, ties, a text of one character, a very long text.
@pytest.fixture
def odd_rows():
    return [(1, "same text here"), (1, "same text here"), (2, "same text here"), (None, "no key"), (3, None), (4, ""), (5, "x"), (6, "long word " * 30_000)]
