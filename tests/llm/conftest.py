from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, piece int, ids string, score double, node bigint"
LONG = "the quick brown fox jumps over a lazy dog while it rains in the old town " * 120


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, other scripts, and columns named like those of the operators."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en"),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en"),
        (2, None, "en"),
        (3, "", None),
        (4, LONG, "en"),
        (5, "Привет мир 日本語 🎉 naïve ▁ x\x1cy z", None),
        (6, "  \n\t ", "de"),
        (7, "12345 !!! ---", "de"),
        (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "fr"),
        (8, LONG + " end", "en"),
        (9, "one two", "de"),
        (10, "One  TWO\n", "de"),
        (11, "a\nb\n\nc\n", "es"),
    ]
    return spark.createDataFrame([(i, t, la, "s", len(t or ""), 0, "x", 0.5, 7) for i, t, la in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
