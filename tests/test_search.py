import json
import math
import re
from collections import Counter

import pytest

from webtext.operators import search


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [(1, "vasya", "red fox"), (2, "petya", "Red red dog"), (3, None, "blue"), (4, "x", None)],
        "id int, nickname string, text string",
    )


def ids(df):
    return [r["id"] for r in df.collect()]


def test_match_ranks_any_token(small):
    hits = search.match(small, "text", "RED dog", "id")
    assert ids(hits.top()) == [2, 1]
    assert hits.total().first()["total"] == 2


def test_term_is_not_analysed(small):
    assert ids(search.term(small, "nickname", "vasya", "id").top()) == [1]
    assert ids(search.term(small, "nickname", "vasya", "id", analysed=False).top()) == [1]
    assert search.term(small, "text", "Red", "id").total().first()["total"] == 0
    assert search.term(small, "text", "red fox", "id").total().first()["total"] == 0
    assert search.term(small, "text", "red fox", "id", analysed=False).total().first()["total"] == 1


def test_match_all(small):
    hits = search.match_all(small, "id")
    assert hits.total().first()["total"] == 4
    assert hits.top(2).count() == 2


def test_no_tokens_no_hits(small):
    assert search.match(small, "text", "?!", "id").top().collect() == []


def test_unknown_column_is_an_error(small):
    with pytest.raises(Exception, match="date"):
        search.match(small, "date", "21.03.2022", "id").top().collect()


def test_sources_leave_nulls_out(small):
    rows = search.match(small, "text", "blue", "id").sources().collect()
    assert json.loads(rows[0]["_source"]) == {"id": 3, "text": "blue"}


def test_substring_is_no_hit(spark):
    df = spark.createDataFrame([(1, "infrared"), (2, "red-hot"), (3, "redé")], "id int, text string")
    assert ids(search.match(df, "text", "red", "id").top()) == [2]


def test_scores_against_plain_python(documents):
    query = "the worthless the que"
    rows = documents.select("doc_id", "text").collect()
    tokens = {r["doc_id"]: re.findall(r"[^\W_]+", r["text"].lower()) for r in rows}
    mean = sum(map(len, tokens.values())) / len(tokens)
    expected = Counter()
    for term in query.split():
        df = sum(term in t for t in tokens.values())
        for key, found in tokens.items():
            tf = found.count(term)
            if tf:
                idf = math.log(1 + (len(tokens) - df + 0.5) / (df + 0.5))
                expected[key] += idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(found) / mean))
    got = search.match(documents, "text", query, "doc_id").matched.select("doc_id", "_score").collect()
    assert {r["doc_id"]: round(r["_score"], 9) for r in got} == {k: round(v, 9) for k, v in expected.items()}


def test_keyword_filter_reaches_the_scan(documents):
    hits = search.term(documents, "lang", "de", "doc_id", analysed=False)
    assert "EqualTo(lang,de)" in hits.matched._jdf.queryExecution().executedPlan().toString()


def test_top_hits_use_no_full_sort(documents):
    plan = search.match(documents, "text", "the", "doc_id").top()._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Join" not in plan
