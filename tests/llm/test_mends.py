"""Ties of equal vectors, letters by category, hashes of words, back-pointers of long texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webtext.llm import ann, jaccard, langid
from webtext.llm.queries import QUERIES
from webtext.llm.words import _CHUNK, word_hashes


@pytest.mark.parametrize("queries, rows", [(q, r) for q in (1, 7, 51, 92, 130) for r in (21, 25, 64, 99, 167, 236, 301, 512, 513, 700, 801, 999)])
def test_equal_vectors_tie_by_id(queries, rows):
    rng = np.random.default_rng(queries * rows)
    vectors = rng.normal(size=(queries + rows, 64))
    ids = np.concatenate((10_000 + np.arange(queries), np.arange(rows)))
    equal = queries + rng.choice(rows, 12, replace=False)
    vectors[equal] = vectors[0] * 2  # the best rows of query 0, and in the middle for others
    size = len(vectors)
    columns = {
        "side": pa.array(np.arange(size) >= queries, pa.bool_()).cast(pa.int8()),
        "vec_id": pa.array(ids),
        "embedding": pa.array(list(vectors)),
        "query": pa.array(ids),
        "cells": pa.array([b"\x80"] * size),
        "cell": pa.array(np.zeros(size, np.int32)),
    }
    query, _, found, score = ann._best(pa.table(columns), 20, 1)
    for i in range(queries):
        exact = (vectors[i] * vectors[queries:]).sum(axis=1)
        want = np.lexsort((np.arange(rows), -exact))[:20]
        at = query == ids[i]
        assert found[at].tolist() == want.tolist() and score[at].tolist() == exact[want].tolist()


def test_recall_of_the_registered_search(spark):
    data = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    vectors, ids = np.array(rows["embedding"].tolist(), float), rows["vec_id"].to_numpy()
    got = {}
    for row in QUERIES["op3_approximate_nearest_neighbours"](spark, data).collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        scores = vectors @ vectors[ids == query][0]
        scores[ids == query] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits, total = hits + len(best & set(got[query])), total + len(best)
    assert hits / total >= 0.9


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "the house is red and the water is cold", "en"), (2, "½ ² Ⅷ ④ 五", None), (3, "½ ² Ⅷ 12", None)], "doc_id bigint, text string, lang string")
    got = {row.doc_id: (row.lang_pred, row.score) for row in langid.fit(docs).predict(docs).collect()}
    assert got[1][0] == "en" and got[2][0] == "en" and got[3] == ("und", 0.0)  # the last sign of 2 is a letter


def test_a_mix_of_known_languages_is_certain(spark):
    docs = spark.createDataFrame(
        [(1, "the house is red and the water is cold " * 9, "en"), (2, "das haus ist rot und das wasser ist kalt " * 9, "de"), (3, "la maison est rouge et froide " * 9, "fr"), (4, "la casa roja y el agua es fria " * 9, "es")],
        "doc_id bigint, text string, lang string",
    )
    mixed = " ".join(row.text for row in docs.collect())
    others = spark.createDataFrame([(5, mixed), (6, "日本語の文章です"), (7, None), (8, "12 !?")], "doc_id bigint, text string")
    assert {row.doc_id for row in langid.fit(docs).certain(others, 0.34).collect()} == {5}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=5), st.integers(1, 11), st.integers(0, 10_000))
def test_viterbi_equals_a_plain_one(sizes, labels, seed):
    for block in (1, 2, 3, 64):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(langid, "_BLOCK", block)
            check_viterbi(sizes, labels, seed)


def check_viterbi(sizes, labels, seed):
    scores = np.random.default_rng(seed).normal(size=(sum(sizes), labels)) * 3
    got, at = langid.viterbi(scores, np.array(sizes), 2.0), 0
    for size in sizes:
        own = scores[at : at + size]
        if size:
            best = own[0]
            for row in own[1:]:
                best = np.maximum(best, best.max() - 2.0) + row
            path = got[at : at + size]
            assert np.isclose(own[np.arange(size), path].sum() - 2.0 * (path[1:] != path[:-1]).sum(), best.max())
        at += size


BLANKS = " \t\n\x0b\x0c\r"


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aAbZé日\xa0\x85. " + BLANKS), max_size=60))
def test_words_and_their_hashes(text):
    data = text.encode()
    begins, hashes = word_hashes(data)
    words = data.lower().split()
    assert [data.lower()[b : b + len(w)] for b, w in zip(begins, words)] == words and len(begins) == len(words)
    assert len(set(hashes.tolist())) == len(set(words))
    assert [word_hashes(w)[1][0] for w in words] == hashes.tolist()


def test_hashes_do_not_depend_on_chunks():
    words = [b"w%d" % i for i in range(60_000)] + [b"L" * 65, b"l" * 64, b"x" * (2 * _CHUNK)] + [b"w%d" % i for i in range(60_000)]
    begins, hashes = word_hashes(b" ".join(words))
    assert len(hashes) == len(words) and (hashes[:60_000] == hashes[60_003:]).all()
    assert len(set(hashes.tolist())) == 60_003 and word_hashes(b"l" * 65)[1][0] == hashes[60_000]


def test_no_chance_equality_among_many_words():
    rng = np.random.default_rng(2)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)
    words = {letters[rng.integers(0, 36, n)].tobytes() for n in rng.integers(1, 20, 400_000)}
    assert len(set(word_hashes(b"\n".join(sorted(words)))[1].tolist())) == len(words)


def test_fingerprints_of_empty_sets():
    assert jaccard.fingerprints([]) == [] and jaccard.fingerprints([np.zeros(0, np.uint64)]) == [None]
