from __future__ import annotations

import pytest

EXTRA = "doc_id long, text string, source string, lang string, n_chars long, rep string, key int, label int, component_id string, mix_slot string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like those operators make."""

    def make(rows):
        return spark.createDataFrame([(d, t, s, None, None, "x", 1, 7, "c", "m") for d, t, s in rows], EXTRA)

    return make


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_rows():
    return [(1, None, "a"), (2, "", None), (None, "some text without an id at all", "a"), (3, " \t\n ", "b"), (4, LONG, "b"), (5, LONG + " tail", "b"), (5, LONG + " tail", "b"), (6, "one", None), (7, "ONE", "c")]
