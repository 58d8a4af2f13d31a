from __future__ import annotations

import pytest


@pytest.fixture
def docs_of(spark):
    """A table of documents from (doc_id, text, lang, source), with columns of clashing names."""

    def make(rows):
        full = [
            (*(list(r) + [None] * (4 - len(r))), len(r[1]) if r[1] is not None else None, "x", "y", 7)
            for r in rows
        ]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "id string, class string, key long",
        )

    return make
