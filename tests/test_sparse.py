"""Sparse logistic regression beside a dense solver, and word vectors from co-occurrence."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtext.operators import cooccurrence, sparse
from webtext.plans import features, registry


def solve(x, y, c):
    """Newton's method in the space of the rows, where the best weights lie; the last column is the free intercept."""
    space, rows = np.linalg.qr(x.T)
    x = np.hstack((rows.T, np.ones((len(x), 1))))
    penal = np.ones(x.shape[1])
    penal[-1] = 0
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        g = c * x.T @ (p - y) + penal * w
        h = c * (x.T * (p * (1 - p))) @ x + np.diag(penal + 1e-12)
        w = w - np.linalg.solve(h, g)
    return space @ w[:-1], w[-1]


def dense(cells, keys):
    terms = sorted({t for _, t, _ in cells})
    at, row = {t: i for i, t in enumerate(terms)}, {k: i for i, k in enumerate(keys)}
    x = np.zeros((len(keys), len(terms)))
    for k, t, v in cells:
        if k in row:
            x[row[k], at[t]] += v
    return x, terms


def test_fit_equals_a_dense_solver(spark):
    rng = np.random.default_rng(8)
    true = rng.normal(size=25)
    cells, labels = [], []
    for key in range(120):
        row = {f"t{int(i):02}": float(abs(rng.normal())) for i in rng.choice(25, rng.integers(1, 8), replace=False)}
        margin = sum(v * true[int(t[1:])] for t, v in row.items()) - 0.5
        cells += [(key, t, v) for t, v in row.items()]
        labels.append((key, int(rng.random() < 1 / (1 + math.exp(-2 * margin)))))
    labels += [(500, 1), (501, None)]  # a row without cells, a row without a label
    cells += [(501, "only there", 1.0), (900, "t00", 1.0)]
    x, terms = dense([cell for cell in cells if cell[0] < 500], [key for key, label in labels if label is not None])
    w, b = solve(x, np.array([label for _, label in labels if label is not None]), 2.0)
    frame = spark.createDataFrame(cells, "id bigint, term string, value double")
    model = sparse.SparseLogisticModel.fit(frame, spark.createDataFrame(labels, "id bigint, y int"), "id", "y", c=2.0, tolerance=1e-4)
    got = {r.term: r.weight for r in model.weights.collect()}
    assert set(got) == set(terms)
    assert np.allclose([got[t] for t in terms], w, atol=2e-3) and abs(model.intercept - b) < 2e-3
    new = [(1, "t00", 2.0), (1, "unknown", 9.0), (2, "t01", 1.0), (2, "t02", 1.0)]
    scored = model.predict(spark.createDataFrame(new, "id bigint, term string, value double"), spark.range(1, 4), "id")
    b = model.intercept
    want = {1: b + 2 * got["t00"], 2: b + got["t01"] + got["t02"], 3: b}
    assert {r.id: round(r.probability, 4) for r in scored.collect()} == {k: round(1 / (1 + math.exp(-m)), 4) for k, m in want.items()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_round_broadcasts_nothing_and_leaves_the_blocks(spark):
    rows = [(k, [1.0], [0, 1 + k % 3], [1.0, 2.0]) for k in range(9)]
    frame = sparse.materialise(spark.createDataFrame(rows, "key bigint, label array<double>, number array<bigint>, value array<double>"), "rows")
    fit = sparse._Fit.of(frame, 1.0)
    margins = sparse.materialise(fit.blocks.select("_block", "label", F.transform("label", lambda _: F.lit(0.0)).alias("m")), "margins")
    state = sparse.materialise(fit.gradient(margins).select("number", F.col("slope").alias("d")), "state")
    assert {r.number: r.d for r in state.collect()} == {0: -4.5, 1: -3.0, 2: -3.0, 3: -3.0}
    assert [m for r in fit.along(margins, state).collect() for m in r.md] == [-10.5] * 9
    for plan in (plan_of(fit.along(margins, state)), plan_of(fit.gradient(margins))):
        assert "Broadcast" not in plan and "Bucketed: true" in plan


def test_repeated_and_null_keys(spark):
    """A key that stands twice is two rows with twice the cells; a null key takes no part."""
    cells = [(1, "a", 1.0), (2, "b", 1.0), (3, "a", 0.5), (None, "a", 9.0)]
    labels = [(1, 1), (1, 1), (2, 0), (3, 0), (None, 1)]
    frames = spark.createDataFrame(cells, "id bigint, term string, value double"), spark.createDataFrame(labels, "id bigint, y int")
    model = sparse.SparseLogisticModel.fit(*frames, "id", "y", tolerance=1e-4)
    x, y = np.array([[2, 0, 2.0], [2, 0, 2], [0, 1, 1], [0.5, 0, 1]]), np.array([1, 1, 0, 0])
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        penal = np.diag([1, 1, 1e-12])
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x + penal, x.T @ (p - y) + penal @ w)
    got = {r.term: r.weight for r in model.weights.collect()}
    assert np.allclose([got["a"], got["b"], model.intercept], w, atol=2e-3)


def test_no_labels_and_no_cells(spark):
    none = spark.createDataFrame([], "id bigint, term string, value double")
    model = sparse.SparseLogisticModel.fit(none, spark.createDataFrame([], "id bigint, y int"), "id", "y")
    assert model.weights.count() == 0 and model.intercept == 0.0
    only = sparse.SparseLogisticModel.fit(none, spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "id bigint, y int"), "id", "y")
    assert abs(only.intercept - math.log(2)) < 1e-3


def test_predictions_of_all_test_rows_equal_a_dense_solver(spark, data):
    """The registered query on the whole TF-IDF matrix of the final texts."""
    kept = {}
    fit = sparse.SparseLogisticModel.fit.__func__

    def watched(cls, cells, labels, *args, **more):
        kept["cells"], kept["labels"] = cells, labels
        return fit(cls, cells, labels, *args, **more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sparse.SparseLogisticModel, "fit", classmethod(watched))
        predict = sparse.SparseLogisticModel.predict
        patch.setattr(sparse.SparseLogisticModel, "predict", lambda self, cells, *a: (kept.__setitem__("test", cells), predict(self, cells, *a))[1])
        got = {r.doc_id: r.probability for r in registry.QUERIES["tfidf_logreg_predictions"](spark, data).collect()}
    labels = {r.doc_id: r.target for r in kept["labels"].collect() if r.target is not None}
    cells = [tuple(r) for r in kept["cells"].collect()]
    x, terms = dense([cell for cell in cells if cell[0] in labels], list(labels))
    w, b = solve(x, np.array(list(labels.values()), float), 1.0)
    weight = dict(zip(terms, w))
    margins = Counter()
    for key, term, value in map(tuple, kept["test"].collect()):
        margins[key] += value * weight.get(term, 0.0)
    assert len(got) == features._final_split(spark, data)[1].count()
    assert all(abs(p - 1 / (1 + math.exp(-margins[key] - b))) < 1e-3 for key, p in got.items())


def test_numbers_follow_the_terms(spark):
    words = [f"w{i}" for i in range(3000)]
    random.Random(1).shuffle(words)
    got = sparse.numbered(spark.createDataFrame([(w,) for w in words], "term string").repartition(7)).collect()
    assert [r.term for r in sorted(got, key=lambda r: r.number)] == sorted(words) and sorted(r.number for r in got) == list(range(1, 3001))


def sentences(spark, rows):
    return spark.createDataFrame([(row,) for row in rows], "tokens array<string>")


def test_pairs_equal_counting(spark):
    rng = random.Random(2)
    rows = [[rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(30)] + [None, [], ["a"], ["a", None, "b"]]
    for window in (1, 3):
        want = Counter()
        for row in rows:
            for i, x in enumerate(row or []):
                for j, y in enumerate(row):
                    if 0 < abs(i - j) <= window and x and y:
                        want[x, y] += 1
        got = cooccurrence.pairs(sentences(spark, rows), "tokens", window).collect()
        assert {(r.a, r.b): r.n for r in got} == want and len(got) == len(want)


def test_planted_synonyms_are_nearest(spark):
    rng = random.Random(3)
    topics = {f"topic{t}": [f"t{t}w{i}" for i in range(6)] for t in range(12)}
    rows = []
    for _ in range(900):
        name, words = rng.choice(sorted(topics.items()))
        word = rng.choice([f"{name}big", f"{name}large"])
        rows.append([rng.choice(words), rng.choice(words), word, rng.choice(words), "the", rng.choice(words)])
    vectors = cooccurrence.train(sentences(spark, rows), "tokens", size=16, window=3, rounds=4)
    assert vectors.size == 16 and vectors.table.count() == len({w for row in rows for w in row})
    for t in range(12):
        near = [r.word for r in cooccurrence.neighbours(vectors, f"topic{t}big", 7).collect()]
        assert f"topic{t}large" in near and all(w.startswith((f"topic{t}l", f"t{t}w")) for w in near)


def test_low_rank_equals_the_singular_subspace(spark):
    rng = random.Random(5)
    rows = [[rng.choice("abcdefgh"[: rng.choice([2, 5, 8])]) for _ in range(9)] for _ in range(60)]
    frame = sentences(spark, rows)
    pmi = cooccurrence.shifted_pmi(frame, "tokens", 2).collect()
    words = sorted({r.a for r in pmi})
    m = np.zeros((len(words), len(words)))
    for r in pmi:
        m[words.index(r.a), words.index(r.b)] = r.pmi
    assert np.allclose(m, m.T)
    got = {r.word: r.vector for r in cooccurrence.train(frame, "tokens", size=2, window=2, rounds=15).table.collect()}
    own = np.array([got[w] for w in words])
    best = np.linalg.eigvalsh(m @ m)[-2:].sum()
    assert 0.98 * best <= (own**2).sum() <= best * (1 + 1e-9)


def test_no_sentences(spark):
    assert cooccurrence.train(sentences(spark, [None, []]), "tokens", size=4).table.count() == 0
    one = cooccurrence.train(sentences(spark, [["alone"]]), "tokens", size=4).table.collect()
    assert [(r.word, r.vector) for r in one] == [("alone", [0.0] * 4)]
