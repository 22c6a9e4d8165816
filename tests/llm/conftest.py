from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """A frame of documents from texts, or from (id, text) pairs, with further columns under the operators' own names."""

    def made(*texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, None, "s", None, "x", 1, [1]) for i, t in rows]
        extra = ", spans string, id long, bands array<int>"
        return spark.createDataFrame(rows, DOC + extra)

    return made
