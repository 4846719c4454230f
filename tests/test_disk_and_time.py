"""What the queries over large vocabularies write, shuffle and compute again."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from webtext import session
from webtext.operators import cooccurrence, embedding, lemmas, sparse
from webtext.operators.embedding import WordVectors


def test_tags_are_made_once_a_row(spark, monkeypatch):
    """A token's class is not looked up in tags that are made anew for every token, also where the table is large."""
    given = []
    written = lemmas.materialise
    monkeypatch.setattr(lemmas, "IN_ROW_BYTES", -1)
    monkeypatch.setattr(lemmas, "materialise", lambda df, name: given.append(df) or written(df, name))
    table = spark.createDataFrame([("cats", "n", "cat"), ("runs", "v", "run")], "token string, cls string, lemma string")
    df = spark.createDataFrame([(1, "cats runs cats"), (2, None), (3, "")], "id int, s string").select("id", F.split("s", " ").alias("t"))
    tags = F.transform("t", lambda t: F.when(F.startswith(t, F.lit("r")), "Г").otherwise("С"))
    got = {r.id: r.lemmatized for r in lemmas.lemmatize(df, "id", F.col("t"), table, tags).collect()}
    assert got == {1: "cat run cat", 2: None, 3: ""}
    plan = given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "get(transform" not in plan


def test_tags_that_are_fewer_or_more_than_tokens(spark, monkeypatch):
    table = spark.createDataFrame([("a", "n", "A"), ("a", "v", "V"), ("a", None, "x"), (None, "n", "x")], "token string, cls string, lemma string")
    rows = [(1, ["a", None, "a"], ["Г"]), (2, ["a"], ["С", "Г"]), (3, ["a", "é", "a"], None), (4, ["é", "a"], ["", "Г"])]
    df = spark.createDataFrame(rows, "id int, t array<string>, g array<string>")
    for limit in (1 << 20, -1):
        monkeypatch.setattr(lemmas, "IN_ROW_BYTES", limit)
        got = {r.id: r.lemmatized for r in lemmas.lemmatize(df, "id", F.col("t"), table, F.col("g")).collect()}
        assert got == {1: "V A", 2: "A", 3: "A é A", 4: "é V"}


def test_written_tables_leave_no_shuffle_files(spark):
    """What a job shuffled is gone when its table is written, and a discarded table is gone too."""
    before = spark.conf.get(session.CLEANUP, None)
    held = _shuffle_files(spark)
    table = session.materialise(spark.range(1000).repartition(7).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
    assert not _shuffle_files(spark) - held and spark.conf.get(session.CLEANUP, None) == before
    assert table.count() == 100
    session.discard(table, spark.range(3))
    assert not os.path.exists(table._written_to.removeprefix("file://"))


def _shuffle_files(spark):
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {path for d in dirs for path in glob.glob(f"{d.getPath()}/*/shuffle_*")}


ROWS = [["a", "b", None, "a", "a"], ["c", "b", "a", "é"], [], None, ["a"] * 4, ["é", "c", "b"], ["rare", "a", "b", "c"]]


def test_pairs_of_many_chunks_and_parts(spark, monkeypatch):
    """Chunks and parts of a few tokens count as one pass over all rows; a rare word keeps its place."""
    monkeypatch.setattr(cooccurrence, "CHUNK_TOKENS", 5)
    monkeypatch.setattr(cooccurrence, "PART_PAIRS", 7)
    df = spark.createDataFrame([(row,) for row in ROWS], "t array<string>").repartition(3)
    often = Counter(w for row in ROWS for w in row or [])
    for least in (1, 2):
        want = Counter()
        for row in ROWS:
            for i, x in enumerate(row or []):
                for y in row[i + 1 : i + 3]:
                    if x and y and min(often[x], often[y]) >= least:
                        want[x, y] += 1
                        want[y, x] += 1
        _, counted = cooccurrence._half(df, "t", 2, least)
        assert dict(counted.dtypes) == {"a": "bigint", "b": "bigint", "n": "bigint"}
        total, sums = sum(want.values()), Counter()
        for (x, _), n in want.items():
            sums[x] += n
        pmi = {(r.a, r.b): r.pmi for r in cooccurrence.shifted_pmi(df, "t", 2, least).collect()}
        expected = {k: math.log(n * total / (sums[k[0]] * sums[k[1]])) for k, n in want.items()}
        assert pmi == pytest.approx({k: x for k, x in expected.items() if x > 0})


def test_training_leaves_its_result_alone(spark, monkeypatch):
    """Pairs, weights, blocks and the factors of all rounds are gone when the vectors are written."""
    written = []

    def kept(df, name):
        written.append((name, session.materialise(df, name)))
        return written[-1][1]

    monkeypatch.setattr(cooccurrence, "materialise", kept)
    monkeypatch.setattr(sparse, "materialise", kept)
    df = spark.createDataFrame([(row,) for row in ROWS], "t array<string>")
    vectors = cooccurrence.train(df, "t", size=3, window=2, rounds=2)
    assert len(written) > 8 and [name for name, table in written if os.path.exists(table._written_to.removeprefix("file://"))] == ["word-vectors"]
    assert vectors.table.count() == 5


def test_blocks_trained_in_one_task_give_sums(spark, monkeypatch):
    """A word of several blocks of a task leaves it once, and the mean is that of a task for each block."""
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([([f"w{i}" for i in rng.integers(0, 9, 20)],) for _ in range(90)], "t array<string>").coalesce(1)
    df = session.materialise(df, "given")
    got, sent = {}, {}
    for together in (1, 6):
        monkeypatch.setattr(embedding, "TOGETHER", together)
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 1))
        made = []
        monkeypatch.setattr(embedding, "materialise", lambda x, name: made.append((name, x)) or session.materialise(x, name))
        discarded = []
        monkeypatch.setattr(embedding, "discard", lambda *tables: discarded.extend(tables))
        got[together] = {r.word: r.vector for r in WordVectors.train(df, "t", size=4, partitions=6).table.collect()}
        plan = dict(made)["word-vectors"]._jdf.queryExecution().optimizedPlan().toString()
        assert "sum(times" in plan
        sent[together] = len(discarded)
    assert set(got[1]) == set(got[6]) == {f"w{i}" for i in range(9)} and sent == {1: 2, 6: 2}
    for word, vector in got[1].items():
        assert vector == pytest.approx(got[6][word], rel=1e-5, abs=1e-7)
