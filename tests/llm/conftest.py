from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """documents from texts: ids 0, 1, ..., two sources, an extra column with a clashing name."""

    def make(texts, **more):
        rows = [(k, t, "en", f"src{k % 2}", None if t is None else len(t), 0.5) for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score DOUBLE")

    return make


LONG = "wort " * 60_000
#: Null, empty, blank, very long, repeated, not ASCII, and control characters.
ODD = [None, "", " \t\n", LONG, "twice the same", "twice the same", "été Straße ñandú 日本語 𝄞", "a\x00b\x1fc\x85d e", "x"]
