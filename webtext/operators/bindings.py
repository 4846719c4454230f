"""Topic bindings as a table: many patterns at once, by a walk over a trie of their words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.operators.lookup import fits_broadcast, lookup
from webtext.session import materialise

#: Steps of the walk between two writes of its state, which cut the lineage.
WRITE_EVERY = 4


def _node(n):
    """The first ``n`` words of a pattern, each ended by a dot."""
    return F.array_join(F.transform(F.slice("_w", 1, n), lambda word: F.concat(word, F.lit("."))), "")


def _trie(patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges ``(node, word, next)`` and ends ``(node, pattern)``.

    A node is the beginning of a pattern, the root ``''``. An edge also leads to what follows by
    ``#`` for no words; a ``#`` node stays where it is for any word, given as the word ``#``.
    """
    parts = patterns.select("pattern", F.split("pattern", r"\.").alias("_w"))
    steps = parts.select("_w", F.posexplode("_w").alias("_i", "word"))
    reached = F.filter(
        F.sequence(F.col("_i") + 1, F.size("_w")),
        lambda j: F.forall(F.slice("_w", F.col("_i") + 2, j - F.col("_i") - 1), lambda word: word == "#"),
    )
    edges = steps.withColumn("_j", F.explode(reached)).select(_node(F.col("_i")).alias("node"), "word", _node(F.col("_j")).alias("next"))
    hash_nodes = steps.filter(F.col("word") == "#").select(_node(F.col("_i") + 1).alias("node"))
    stays = hash_nodes.select("node", F.lit("#").alias("word"), F.col("node").alias("next"))
    ends = parts.select(_node(F.size("_w")).alias("node"), "pattern")
    # A ``#`` taken for no words is part of the edge before it; as a word of its own it only stays.
    return edges.filter(F.col("word") != "#").unionByName(stays).distinct(), ends


def match_bindings(keys: DataFrame, bindings: DataFrame) -> DataFrame:
    """Keys with each pattern that fits them: ``(key, pattern)``, both distinct.

    ``keys`` is ``(key)`` and ``bindings`` is ``(pattern)``: ``*`` is one word, ``#`` any number of
    words. All patterns are walked together, one word of the keys a step, so the work follows the
    states that keys really reach and not keys times patterns. The edges are broadcast if they are
    small, else joined by salted keys. NULL keys and patterns match nothing. A word ``*`` or ``#``
    in a key is a word like any other and is matched by wildcards only.
    """
    patterns = bindings.select("pattern").filter(F.col("pattern").isNotNull()).distinct()
    edges, ends = _trie(patterns)
    edges = materialise(edges, "binding-edges")
    small = fits_broadcast(edges)
    leading = patterns.agg(F.max(F.length(F.regexp_extract("pattern", r"^((?:#(?:\.|$))*)", 1)))).first()[0] or 0
    roots = F.transform(F.sequence(F.lit(0), F.lit((leading + 1) // 2)), lambda n: F.repeat(F.lit("#."), n))

    distinct = keys.select("key").filter(F.col("key").isNotNull()).distinct()
    states = distinct.select("key", F.split("key", r"\.").alias("_words"), F.explode(roots).alias("node"))
    longest = distinct.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 0
    done = [states.select("key", "node").limit(0)]
    for i in range(longest):
        word = F.get("_words", F.lit(i))
        labels = F.array_compact(F.array(F.when(~word.isin("*", "#"), word), F.lit("*"), F.lit("#")))
        moves = states.filter(F.size("_words") > i).select("key", "_words", "node", F.explode(labels).alias("word"))
        on = ["node", "word"]
        moved = moves.join(F.broadcast(edges), on) if small else lookup(moves, edges, on, "key", broadcast_bytes=0)
        states = moved.select("key", "_words", F.col("next").alias("node")).distinct()
        if i % WRITE_EVERY == WRITE_EVERY - 1:
            states = materialise(states, "binding-states")
        done.append(states.filter(F.size("_words") == i + 1).select("key", "node"))
    return lookup(reduce(DataFrame.unionByName, done), ends, ["node"], "key").select("key", "pattern").distinct()


def route_bindings(messages: DataFrame, bindings: DataFrame, column: str = "exchange") -> DataFrame:
    """One row per message and binding whose pattern fits; columns of both.

    Patterns are matched with the distinct source names only; a name with a third of all messages
    is matched once, and its messages stay where they are while the matches fit a broadcast.
    """
    matched = materialise(match_bindings(messages.select(F.col(column).alias("key")), bindings), "bindings")
    routes = matched.join(bindings, "pattern").withColumnRenamed("key", column)
    return lookup(messages, materialise(routes, "binding-routes"), [column], next((c for c in messages.columns if c != column), column))
