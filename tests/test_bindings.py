"""Bindings in a table against one regular expression per pattern; scans over fields of differing type."""

import itertools
import re

import pytest
from pyspark.sql import types as T

from webtext.operators import bindings
from webtext.operators.logs import topic_pattern
from webtext.sources import collections as store


def fits(pattern, key):
    """The words, one after the other."""

    def go(p, k):
        if not p:
            return not k
        if p[0] == "#":
            return go(p[1:], k) or bool(k) and go(p, k[1:])
        return bool(k) and p[0] in ("*", k[0]) and go(p[1:], k[1:])

    return go(pattern.split("."), key.split("."))


WORDS = ["a", "b", "*", "#"]
PATTERNS = [".".join(p) for n in (1, 2, 3) for p in itertools.product(WORDS, repeat=n)] + ["#.#.#.a.#.#", "a.*.#.b.*"]
KEYS = [".".join(k) for n in (1, 2, 3, 5) for k in itertools.product("ab", repeat=n)] + ["c", "a.c.b"]


def test_bindings_equal_the_plain_walk(spark):
    keys = spark.createDataFrame([(k,) for k in [*KEYS, *KEYS[:3], None]], "key string")
    table = spark.createDataFrame([(p,) for p in [*PATTERNS, *PATTERNS[:3], None]], "pattern string")
    found = [(r["key"], r["pattern"]) for r in bindings.match_bindings(keys, table).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(k, p) for k in KEYS for p in PATTERNS if fits(p, k)}
    # The regular expressions of single bindings agree where Python can run them.
    for k, p in itertools.product(["a", "a.b", "a.c.b"], ["a.#", "*.b", "#.b", "a.*.b"]):
        expression = re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), topic_pattern(p))
        assert bool(re.match(expression, k)) == fits(p, k)


def test_routes_keep_messages_and_bindings(spark):
    messages = spark.createDataFrame([(1, "a.b"), (2, "a.b"), (2, "a.b"), (3, "z"), (4, None)], "id int, exchange string")
    table = spark.createDataFrame([("a.*", "q1"), ("a.*", "q2"), ("#", "all"), (None, "none")], "pattern string, queue string")
    rows = bindings.route_bindings(messages, table).collect()
    assert sorted((r["id"], r["queue"]) for r in rows) == sorted(
        [(i, q) for i in (1, 2, 2) for q in ("q1", "q2", "all")] + [(3, "all")]
    )


def test_empty_tables(spark):
    keys = spark.createDataFrame([], "key string")
    table = spark.createDataFrame([], "pattern string")
    some = spark.createDataFrame([("a",)], "key string")
    assert bindings.match_bindings(keys, table).count() == 0
    assert bindings.match_bindings(some, table).count() == 0
    assert bindings.match_bindings(some.select("key"), table.select("pattern")).columns == ["key", "pattern"]


def test_widest_types():
    assert store.widest([T.IntegerType(), T.LongType(), T.NullType()]) == T.LongType()
    assert store.widest([T.LongType(), T.DoubleType()]) == T.DoubleType()
    assert store.widest([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert store.widest([T.LongType(), T.DateType()]) == T.StringType()
    assert store.widest([T.NullType()]) == T.StringType()


def test_values_that_do_not_fit_are_rescued(spark):
    big = 2**53 + 1
    one = spark.createDataFrame([(1, big, [1, 2])], "a int, b long, c array<int>")
    two = spark.createDataFrame([("x", 0.5, None), ("7", None, "t"), (None, None, None)], "a string, b double, c string")
    rows = store.scan_typed({"one": one, "two": two}, declared={"a": T.LongType()}).collect()
    assert [(r["a"], r["b"], r["c"], r["_rescued"], r["_index"]) for r in rows] == [
        (1, None, "[1,2]", {"b": str(big)}, "one"),
        (None, 0.5, None, {"a": "x"}, "two"),
        (7, None, "t", None, "two"),
        (None, None, None, None, "two"),
    ]
    with pytest.raises(ValueError):
        store.scan_typed({"one": one}, "z")
