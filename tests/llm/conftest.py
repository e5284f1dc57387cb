from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, th string, `a.b` int"


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text[, source]) rows, with columns whose names operators might use too."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, "x", 1) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def awkward(make_docs):
    """Nulls, empty and long texts, repeated rows, one id with two texts."""
    long = " ".join(f"word{i % 997} of the{i % 13}" for i in range(20_000))
    return make_docs([(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (4, "one"), (5, "one two three"), (5, "another text here"),
                      (None, "no id here at all"), (None, None, None), (6, long), (7, long), (8, "é ß 漢字   x", None)])
