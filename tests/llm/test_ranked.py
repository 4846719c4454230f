from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webtext.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(queries, docs, k):
    """``(item, rank, key, score)`` by scoring every document; a null key ranks last among equals."""
    held = [(key, words) for key, text in docs if (words := terms(text))]
    total, length = len(held), sum(len(words) for _, words in held)
    result = []
    for item, text in set(queries):
        weights = {}
        for term in set(terms(text)):
            df = sum(term in words for _, words in held)
            weights[term] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
        scored = []
        for key, words in held:
            m = 100 - 50 + (50 * len(words) * total) // length
            score = sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)) for term, w in weights.items() if (tf := words.count(term)))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        result += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(result, key=repr)


def searched(spark, queries, docs, k):
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in queries], "item_id bigint, text string, rank int, _key int")
    table = spark.createDataFrame([(d, t, "x", 5, 6) for d, t in docs], "doc_id bigint, text string, score string, n int, term int")
    return sorted(map(tuple, ranked.search(items, table.repartition(3), k).collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ09 _-é×÷ſK日🎉\x7f\x80 \n/:@[`{"), max_size=30))
def test_terms_equal_the_pattern(text):
    assert [term.decode() for term in ranked.terms(text)] == terms(text)


def test_equals_scoring_every_document(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]

    def text(size):
        return " ".join(words[min(59, int(x))] for x in rng.exponential(12, size))

    docs = [(i, text(rng.integers(0, 60))) for i in range(150)]
    docs += [(i + 1000, "W1 w2! w3 w4") for i in range(40)]  # ties
    docs += [(None, "w1 w2 w3 w4"), (3, docs[3][1]), (7, None), (8, ""), (9, "?!"), (10, text(20_000)), (11, "naïve 日本語 w59")]
    queries = [(i, text(rng.integers(1, 25))) for i in range(12)]
    queries += [(12, "w1 w2"), (12, "w1 w2"), (13, None), (14, "..."), (15, "unknown"), (12, "w5"), (None, "日本語 NAïVE"), (16, "w1 " * 500)]
    asked = [(i, t) for i, t in queries if t is not None]
    for k in (1, 5, 50):
        assert searched(spark, queries, docs, k) == brute(asked, docs, k)


def test_segments_and_blocks_change_nothing(spark, monkeypatch):
    docs = [(i, f"a{i % 7} b{i % 5} " * (i % 9 + 1) + f"c{i}") for i in range(120)]
    queries = [(i, f"a{i} b{i} c{i}") for i in range(9)]
    want = brute(queries, docs, 6)
    assert searched(spark, queries, docs, 6) == want
    monkeypatch.setattr(ranked, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(ranked, "BLOCK_CHARS", 20)
    assert searched(spark, queries, docs, 6) == want
    corpus = ranked.Corpus(50, 400, np.array([900, 400, 100], np.int64))
    for postings, size in ((1, 40_000), (10, 40_000), (1_500_000, 7)):
        monkeypatch.setattr(ranked, "SEGMENT_POSTINGS", postings)
        monkeypatch.setattr(ranked, "SEGMENT_DOCS", size)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, 151, 3, dtype=np.int32)), pa.array(np.tile(part, 50).astype(np.int32))) for part in ([0, 1, 2], [3, 1, 2])]
        whole = pa.RecordBatch.from_arrays([pa.array(np.arange(50)), pa.array(np.full(50, 8)), *lists], names=["_key", "n", "term", "tf"])
        segments = list(ranked._segments(corpus, iter([whole.slice(0, 20), whole.slice(20, 30)])))
        assert sorted(int(key) for segment in segments for key in segment.keys) == list(range(50))
        assert all(len(segment.impact) == 3 * len(segment.keys) for segment in segments) and len(segments) > (1 if postings < 100 or size == 7 else 0)


def test_a_settled_document_needs_no_deeper_reads(monkeypatch):
    """The best document is settled by the front of its list; the rest of the list is not read."""
    n = 10_000
    tf = np.ones(n, np.int64)
    tf[7] = 500
    corpus = ranked.Corpus(n, 100 * n, np.array([5000], np.int64))
    segment = ranked.Segment(corpus, np.arange(n), np.full(n, 100), np.zeros(n, np.int64), tf, np.ones(n, np.int64))

    read = []
    real = np.searchsorted
    monkeypatch.setattr(ranked.np, "searchsorted", lambda *a, **k: read.append(n - int(real(*a, **k))) or real(*a, **k))
    places, scores = segment.best(np.array([0]), 1)
    assert read == [1]
    assert places.tolist() == [7] and scores[0] == 5000 * ((10**9 * 500) // (1000 * 500 + 20 * 100))
    assert segment.impact[1] * 2 < segment.impact[0]


def test_empty_tables(spark):
    assert searched(spark, [(1, "?"), (2, "")], [(1, "a")], 5) == [] and searched(spark, [], [(1, "a")], 5) == [] and searched(spark, [(1, "a")], [], 5) == []


@pytest.mark.parametrize("df, documents", [(0, 1), (1, 1), (3, 10**12), (10**12, 10**12)])
def test_weight(df, documents):
    assert ranked.weight(df, documents) == math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
