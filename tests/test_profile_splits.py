import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtext.functions import clean
from webtext.operators import profile, splits


def test_value_and_null_counts(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (0, None), (None, 2.0)], "a int, b double")
    assert [tuple(r) for r in profile.value_counts(df, "a").collect()] == [(1, 2), (0, 1)]
    assert {tuple(r) for r in profile.null_counts(df).collect()} == {("a", 1), ("b", 2)}


def test_mean_skips_missing(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (0, 5), (None, 9)], "t int, v int")
    assert {tuple(r) for r in profile.mean_by(df, "t", "v", "m").collect()} == {(1, 2.0), (0, 5.0)}


def test_histogram(spark):
    values = [(1, v) for v in (1, 2, 11)] + [(0, 5), (0, 5), (2, None), (None, 3)]
    df = spark.createDataFrame(values, "t int, v int")
    rows = {tuple(r) for r in profile.histogram_by(df, "t", "v").collect()}
    assert rows == {(1, 0, 1), (1, 1, 1), (1, 9, 1), (0, 5, 2)}


def test_histogram_against_numpy(documents):
    frame = documents.select((F.col("doc_id") % 3).alias("t"), clean.word_count(F.col("text")).alias("v")).cache()
    got = {(r["t"], r["bin"]): r["n"] for r in profile.histogram_by(frame, "t", "v").collect()}
    for t in range(3):
        values = [r["v"] for r in frame.filter(F.col("t") == t).collect()]
        counts, _ = np.histogram(values, bins=10)
        assert {b: n for (c, b), n in got.items() if c == t} == {b: n for b, n in enumerate(counts) if n}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 9, 10, 49, 50])
def test_split_sizes(spark, n):
    df = spark.range(7, 7 + 3 * n, 3)
    first, second = splits.half_split(df, "id")
    ids = [7 + 3 * i for i in range(n)]
    assert sorted(r[0] for r in first.collect()) == ids[: math.ceil(n / 2)]
    assert sorted(r[0] for r in second.collect()) == ids[math.ceil(n / 2) :]
    train, test = splits.train_test_split(df, "id")
    assert test.count() == math.ceil(0.2 * n) and train.count() == n - math.ceil(0.2 * n)
    assert train.intersect(test).count() == 0


def test_split_repeats_and_follows_the_seed(spark):
    df = spark.range(1000)
    one, same, other = (splits.train_test_split(df, "id", seed=s)[1] for s in (1, 1, 2))
    assert one.exceptAll(same).count() == 0
    assert one.exceptAll(other).count() > 50


@pytest.mark.parametrize("scale", [1, 1_000_003, 2**40])
def test_kth_smallest_against_sorting(spark, scale):
    values = [(i * 7919) % 10007 * scale - 5 * scale for i in range(3000)] + [3 * scale] * 2000
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values)
    span = splits.Span.of(df, F.col("v"))
    for k in (1, 2, 777, 2500, 4999, 5000):
        cut = span.kth_smallest(k)
        assert cut.value == ordered[k - 1]
        assert cut.below == sum(v < cut.value for v in values)
        assert cut.equal == values.count(cut.value)


def test_equal_hashes_are_cut_by_key(spark, monkeypatch):
    monkeypatch.setattr(splits, "shuffle_hash", lambda key, seed: F.lit(5).cast("long"))
    train, test = splits.train_test_split(spark.range(10), "id")
    assert sorted(r[0] for r in test.collect()) == [0, 1]


def test_half_split_filter_reaches_the_scan(documents):
    first, _ = splits.half_split(documents, "doc_id")
    assert "LessThanOrEqual(doc_id," in first._jdf.queryExecution().executedPlan().toString()
