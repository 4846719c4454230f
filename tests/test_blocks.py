"""Vectors trained and summed in blocks of rows: nothing of the vocabulary on the driver, few rows moved."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtext import session
from webtext.functions import elements
from webtext.operators import blocks, cooccurrence, embedding, lemmas
from webtext.operators.embedding import WordVectors


def _cosine(a, b):
    return np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)


def test_vectors_are_trained_in_several_blocks(spark, monkeypatch):
    random = np.random.default_rng(0)
    rows = [([f"{kind}{i}" for i in random.integers(0, 6, 30)],) for kind in "xy" for _ in range(400)] + [([],), (None,)]
    df = spark.createDataFrame(rows, "t array<string>").repartition(4)
    seen = []
    words = blocks.words
    monkeypatch.setattr(blocks, "words", lambda rows, tokens: seen.append(rows.select("_block").distinct().count()) or words(rows, tokens))
    table = WordVectors.train(df, "t", size=16, partitions=3).table
    assert seen == [3]
    got = {r.word: r.vector for r in table.collect()}
    assert len(got) == 12 and table.count() == 12
    near = [_cosine(got[f"{k}0"], got[f"{k}{i}"]) for k in "xy" for i in range(1, 6)]
    far = [_cosine(got["x0"], got[f"y{i}"]) for i in range(6)]
    assert min(near) > max(far)
    assert {r.word for r in WordVectors.train(df, "t", size=4, min_count=2000).table.collect()} == {
        w for w in got if sum(t.count(w) for t, in rows if t) >= 2000
    }


def test_long_rows_are_trained_in_pieces_and_no_words_are_an_error(spark):
    long = spark.createDataFrame([([f"w{i}" for i in range(2500)],)], "t array<string>")
    assert WordVectors.train(long, "t", size=3).table.count() == 2500
    with pytest.raises(ValueError):
        WordVectors.train(long.filter("false"), "t", size=3)


def test_means_of_many_blocks_move_no_token_rows(spark, monkeypatch):
    """Repeated and NULL keys, words and vectors count as in a join of token rows."""
    monkeypatch.setattr(embedding, "MEAN_TOKENS", 3)
    monkeypatch.setattr(embedding, "SUMMED", 2)
    table = [("a", [1.0, 2.0]), ("a", [3.0, None]), ("b", [0.5, 1.0]), ("n", None), (None, [9.0, 9.0])]
    rows = [(1, ["a", "b", "a", None]), (1, ["b", "zz"]), (None, ["a"]), (None, None), (2, []), (3, ["n", "zz"]), (4, ["b"] * 9)]
    vectors = WordVectors(spark.createDataFrame(table, "word string, vector array<double>"), 2)
    df = spark.createDataFrame(rows, "id int, t array<string>")
    means = vectors.mean(df, "id", F.col("t"))
    got = {r.id: r.vector for r in means.collect()}
    assert means.count() == 5 and got[2] == got[3] == [0.0, 0.0] and got[4] == [0.5, 1.0]
    assert got[1] == pytest.approx([9 / 6, 6 / 6]) and got[None] == pytest.approx([2.0, 1.0])
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "_salt" not in plan


def test_a_large_table_of_base_forms_is_met_in_blocks(spark, monkeypatch):
    """Repeated and NULL keys keep their own rows; a missing class is a noun; no token is unfolded to be put back."""
    monkeypatch.setattr(lemmas, "IN_ROW_BYTES", -1)
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 2)
    table = spark.createDataFrame([("cats", "n", "cat"), ("ran", "v", "run"), ("x", "n", None)], "token string, cls string, lemma string")
    rows = [(1, ["cats", None, "ran"], ["С", None, "Г"]), (1, ["ran", "cats"], []), (None, ["x"], ["С"]), (None, None, None), (2, [], [])]
    df = spark.createDataFrame(rows, "id int, t array<string>, g array<string>")
    got = lemmas.lemmatize(df, "id", F.col("t"), table, F.col("g"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "cat run"), (1, "ran cat"), (None, "x"), (None, None), (2, "")], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan


def test_large_files_are_dealt_out_by_bytes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "numbers")
    spark.range(20000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    monkeypatch.setattr(session, "TASK_BYTES", 4096)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert df.rdd.getNumPartitions() < 10 < session.spread(df, path).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_product_moves_a_vector_once_to_each_block(spark, monkeypatch):
    monkeypatch.setattr(cooccurrence, "BLOCK_WEIGHTS", 40)
    random = np.random.default_rng(1)
    cells = {(int(a), int(b)): float(x) for a, b, x in zip(random.integers(0, 20, 150), random.integers(0, 20, 150), random.random(150))}
    weights = spark.createDataFrame([(f"w{a}", f"w{b}", x) for (a, b), x in cells.items()], "a string, b string, pmi double")
    matrix = random.random((20, 3))
    factor = spark.createDataFrame([(f"w{i}", v.tolist()) for i, v in enumerate(matrix)], "word string, vector array<double>")
    rows, needs = cooccurrence._dealt(weights)
    assert rows.select("_block").distinct().count() > 1
    got = {r.word: r.vector for r in cooccurrence._product(rows, needs, factor, 3).collect()}
    assert len(got) == len({a for a, _ in cells})
    for word, vector in got.items():
        assert vector == pytest.approx(sum(x * matrix[b] for (a, b), x in cells.items() if f"w{a}" == word))


def test_first_selectors_of_all_paths_share_one_pass(spark, monkeypatch):
    page = "<title>t</title><div class='a b'><p>1<p class='a'>2</div><p>3"
    df = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    passes = []
    spans = elements._spans
    monkeypatch.setattr(elements, "_spans", lambda *given: passes.append(1) or spans(*given))
    paths = {"t": ("title",), "a": (".a",), "b": ("div.b",), "p": ("p",), "none": ("h1",), "all": ()}
    got = elements.locate(df, paths).collect()
    assert len(passes) == 1
    box = "<div class='a b'><p>1<p class='a'>2"
    assert got[0].asDict() == {"html": page, "t": "<title>t", "a": box, "b": box, "p": "<p>1", "none": None, "all": page}
    assert list(got[1])[1:] == [None] * 6 and list(got[2])[1:] == [None] * 5 + [""]
