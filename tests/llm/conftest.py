from __future__ import annotations

import pytest


@pytest.fixture()
def docs(spark):
    """Rows -> documents, with a column whose name the operators use themselves."""

    def make(rows, parts=3):
        full = [(*r, "src0")[:3] for r in rows]
        df = spark.createDataFrame([(i, t, s, "x", 7) for i, t, s in full], "doc_id long, text string, source string, size string, fp int")
        return df.repartition(parts)

    return make


@pytest.fixture()
def odd(docs):
    """Null id, null text, empty, blank, very long, ties and repeated rows."""
    long = "word " * 3000 + "x" * 70000 + " é 漢字 😀 end"
    return docs(
        [(None, "no id here"), (1, None), (2, ""), (3, " \n\t "), (4, long), (5, "same text again and more"), (6, "same text again and more"), (6, "same text again and more"), (7, "Zürich is odd"), (8, None, None)]
    )


@pytest.fixture()
def nothing(docs):
    return docs([(0, "x")]).where("doc_id < 0")
