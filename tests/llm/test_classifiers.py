from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from webtext.llm import langid, toxicity
from webtext.llm.queries import QUERIES


def auc(labels, scores):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    positive = labels.sum()
    return (order[labels == 1].sum() - positive * (positive + 1) / 2) / (positive * (len(labels) - positive))


def test_op2_learns_and_holds_out(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    scored = QUERIES["op2_toxicity"](spark, folder)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = scored.collect()
    assert len(rows) == 1000 and len({r.doc_id for r in rows}) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(y, np.array([r.score for r in held])) > 0.9
    flagged = [labels[r.doc_id] for r in held if r.predicted]
    assert flagged and all(flagged)


def test_labels_held_out_change_nothing(spark, documents):
    from pyspark.sql import functions as F

    labels = documents.select("doc_id", F.col("text").contains("the").cast("int").alias("toxic"))
    held = toxicity.remainder("doc_id", 3) == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [
        sorted(toxicity.fit(documents, table.filter(~held), toxicity.Ftrl(epochs=2)).score(documents).collect()) for table in (labels, other)
    ]
    assert scores[0] == scores[1]


def test_features_are_ngrams_and_skipgrams():
    def of(text):
        return set(toxicity.features([text], 20)[1].tolist())

    assert of("a b c") == of("A, b! c") and len(of("a b c")) == 3 + 3 + 2 + 1
    assert of("a b") < of("a b c") and of("b a") != of("a b")
    doc, _ = toxicity.features(["a b", "", "c"], 20)
    assert sorted(set(doc.tolist())) == [0, 2]


def test_ftrl_gives_few_weights():
    draw = np.random.default_rng(0)
    labels = draw.integers(0, 2, 400).tolist()
    examples = [np.unique(np.append(draw.integers(10, 5000, 30), 3 if y else 4)) for y in labels]
    weights, _ = toxicity.Ftrl(bits=13).fit(examples, labels)
    assert weights[3] > 0 > weights[4] and (weights != 0).sum() < 60


def test_toxicity_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (8, 0), (9, 0), (10, 0), (2, None), (3, 5)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd, labels, toxicity.Ftrl(l1=0.1))
    rows = model.score(odd).collect()
    assert len(rows) == odd.count()
    score = {r.doc_id: r.score for r in rows}
    assert score[1] > score[4] and score[2] == score[3] == score[6] and score[None] == score[1]
    assert model.score(none).count() == 0
    kept = model.below(odd, score[1])
    assert kept.columns == odd.columns and kept.count() == sum(r.score < score[1] for r in rows)
    assert {r.score for r in toxicity.fit(odd, labels.limit(0)).score(odd).collect()} == {0.0}
    assert 0 < toxicity.fit(odd, labels.filter("toxic = 1")).score(odd).first().score <= 1


def brute_path(scores, penalty):
    n, k = scores.shape
    return max(
        (sum(scores[t, s] for t, s in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:])) for path in itertools.product(range(k), repeat=n)),
        default=0.0,
    )


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(4)
    counts = np.array([0, 1, 5, 3, 0, 6])
    scores = draw.normal(0, 3, (counts.sum(), 3))
    labels = langid.viterbi(scores, counts, 2.0)
    at = 0
    for n in counts.tolist():
        own, path = scores[at : at + n], labels[at : at + n]
        value = own[np.arange(n), path].sum() - 2.0 * (path[1:] != path[:-1]).sum()
        assert value == pytest.approx(brute_path(own, 2.0))
        at += n


def test_op5_on_held_out(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    rows = QUERIES["op5_language_id"](spark, folder).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


TRAINING = [
    (1, "the weather is nice and the children play with their friends in the garden", "en"),
    (2, "das wetter ist schön und die kinder spielen mit ihren freunden im garten", "de"),
    (3, "погода хорошая и дети играют с друзьями в саду", "ru"),
]


def test_spans_of_mixed_text_and_scripts(spark):
    docs = spark.createDataFrame(TRAINING, "doc_id int, text string, lang string")
    model = langid.fit(docs, penalty=4.0)
    text = "the children play with their friends, die kinder spielen mit ihren freunden. дети играют"
    found = model.spans(spark.createDataFrame([(1, text), (2, None), (3, "123")], "doc_id int, text string")).collect()
    assert [(r.doc_id, text[r.start : r.end], r.lang) for r in found] == [
        (1, "the children play with their friends", "en"),
        (1, "die kinder spielen mit ihren freunden", "de"),
        (1, "дети играют", "ru"),
    ]


def test_language_of_odd_documents(spark, odd, none):
    model = langid.fit(odd)
    rows = model.predict(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by[2] == by[3] == by[6] == by[7] == ("und", 0.0)
    assert by[4][0] == "en" and by[9][0] == by[10][0] == "de"
    assert by[5][0] in model.languages and by[5][1] < 1
    assert model.predict(none).count() == 0
    kept = model.certain(odd, 0.5)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} & {2, 3, 6, 7} == set()
    nothing = langid.fit(none)
    assert {r.lang_pred for r in nothing.predict(odd).collect()} == {"und"}
