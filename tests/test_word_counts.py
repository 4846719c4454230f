"""Words and word pairs counted in tasks: arrays and texts, null, empty and repeated words, several chunks."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from webtext.operators import blocks, cooccurrence, lemmas

ROWS = [(1, ["b", "a", "b", "b"]), (2, None), (3, []), (4, ["ü", "a"]), (5, ["a"]), (6, ["b", "a", "b", "b"])]


@pytest.fixture()
def given(spark):
    df = spark.createDataFrame(ROWS, "k int, tokens array<string>").repartition(2)
    return df.withColumn("line", F.array_join("tokens", " "))


@pytest.mark.parametrize("column", ["tokens", "line"])
def test_counts(given, column, monkeypatch):
    want = Counter(word for _, row in ROWS for word in row or [])
    assert {r.word: r.n for r in blocks.counted(given, column).collect()} == want


@pytest.mark.parametrize("column", ["tokens", "line"])
def test_pairs(given, column):
    want = Counter()
    for _, row in ROWS:
        for i, x in enumerate(row or []):
            for y in row[i + 1 : i + 3]:
                want[x, y] += 1
                want[y, x] += 1
    assert {(r.a, r.b): r.n for r in cooccurrence.pairs(given, column, 2).collect()} == want


def test_null_words_keep_their_place(spark):
    df = spark.createDataFrame([(["a", None, "b", "c"],)], "tokens array<string>")
    assert {(r.a, r.b, r.n) for r in cooccurrence.pairs(df, "tokens", 1).collect()} == {("b", "c", 1), ("c", "b", 1)}
    assert {(r.word, r.n) for r in blocks.counted(df, "tokens").collect()} == {("a", 1), ("b", 1), ("c", 1)}


def test_base_forms_from_the_cleaned_texts(spark):
    """A table made from the texts: they are cleaned once and handed over written."""
    docs = spark.createDataFrame([(1, "Cats, the DOGS"), (2, None), (3, "")], "k int, text string")
    seen = []

    def table(cleaned):
        seen.append({r.k: r.clean_text for r in cleaned.collect()})
        assert "HashAggregate" not in cleaned._jdf.queryExecution().toString() and cleaned.inputFiles()
        words = blocks.counted(cleaned, "clean_text", "token").filter(F.endswith("token", F.lit("s")))
        return words.select("token", F.lit("n").alias("cls"), F.expr("left(token, length(token) - 1)").alias("lemma"))

    got = {r.k: r.final_text for r in lemmas.final_text(docs, "k", "text", table, ["the"]).collect()}
    assert got == {1: "cat dog", 2: None, 3: ""} and seen == [{1: "cats the dogs", 2: None, 3: ""}]
