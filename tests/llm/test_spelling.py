from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webtext.llm import spelling

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(rows, letters=5, occurrences=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= letters and n >= occurrences}


def brute(words):
    near = {a: sorted((-words[b], b) for b in words if one_edit(a, b)) for a in words}
    form = {a: found[0][1] if found and -found[0][0] >= 2 * words[a] else None for a, found in near.items()}

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return sorted((a, words[a], len(near[a]), form[a] or "", words[form[a]] if form[a] else 0, root(a)) for a in words)


def rows_of(frame):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in frame.collect())


def made(spark, words):
    return spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n bigint")


@settings(max_examples=300, deadline=None)
@given(st.text("abcéÿß×zq", min_size=5, max_size=9), st.integers(0, 8), st.sampled_from("abcéÿßkz"), st.sampled_from(["replace", "insert", "delete"]))
def test_words_one_edit_apart_share_a_signature(word, at, letter, edit):
    at = min(at, len(word) - 1)
    other = word[:at] + {"replace": letter, "insert": letter + word[at], "delete": ""}[edit] + word[at + 1 :]
    place, side, key = (part.tolist() for part in spelling.signatures([word, other]))
    if word != other:
        sides = {(0, 0)} if len(word) == len(other) else {(1, 2) if len(word) < len(other) else (2, 1)}
        own = {(s, k) for p, s, k in zip(place, side, key) if p == 0}
        others = {(s, k) for p, s, k in zip(place, side, key) if p == 1}
        assert any((a, k) in own and (b, k) in others for a, b in sides for _, k in own)
    assert len(place) == 2 * 28


@pytest.mark.parametrize("large", [48, 2])
def test_groups_equal_comparing_all(spark, monkeypatch, large):
    monkeypatch.setattr(spelling, "LARGE", large)
    rng = random.Random(large)
    words = {}
    for _ in range(250):
        word = "".join(rng.choice("aabcdeéß") for _ in range(rng.choice([5, 6, 7, 8])))
        words[word] = rng.choice([3, 4, 7, 20, 100])
        at = rng.randrange(len(word))
        for other in (word[:at] + word[at + 1 :], word[:at] + "z" + word[at:], word[:at] + "ÿ" + word[at + 1 :]):
            if len(other) >= 5 and rng.random() < 0.6:
                words[other] = rng.choice([3, 6, 50])
    for i in range(26):  # many words of one signature
        words["stems" + chr(97 + i)] = 3 + i
        words["stem" + chr(97 + i) + "s"] = 3 + i
    assert rows_of(spelling.variants(made(spark, words))) == brute(words)


def test_roots_of_a_long_chain(spark):
    words = {"a" * (5 + i): 3 * 2**i for i in range(20)}
    got = rows_of(spelling.variants(made(spark, words)))
    assert got == brute(words) and {row[-1] for row in got} == {"a" * 24}


def test_vocabulary_of_odd_documents(spark, odd, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 5)
    more = [(20, "Straße ÀÉÎ× Àéî× straße STRASSE ſtate K"), (21, "alphabeta " * 300)]
    rows = [(r.doc_id, r.text) for r in odd.collect()] + more * 3
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id bigint, text string, n int, word string")
    for repeated in (docs, docs.repartition(4)):
        assert {r.word: r.n for r in spelling.vocabulary(repeated).collect()} == words_of(rows)


def test_every_97th_is_damaged(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = words_of(rows)
    assert {r.word: r.n for r in spelling.vocabulary(documents).collect()} == want


def test_empty_table(spark, none):
    got = spelling.variants(spelling.vocabulary(none))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"] and got.count() == 0
