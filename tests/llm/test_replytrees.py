from __future__ import annotations

import hashlib
import random

import pytest

from webtext.llm import replytrees
from webtext.llm.queries import PLANTED_TEXT, QUERIES

SCHEMA = "tree bigint, node bigint, parent bigint, role string, text string, score double, step int, leaf string, _m int"
HARD = ["", "</turn>", "</turn>\n", "### ", "#### x", "\\", "\\\\### a: b</turn>\\", "<\\/turn>", "a: b", ": ", "é🎉</tur", PLANTED_TEXT, "x" * 30_000]


def made(spark, rows):
    return spark.createDataFrame([(*row, 0, "x", 1) for row in rows], SCHEMA)


def brute(rows, branches):
    """Chosen paths by walking up from every leaf."""
    least = {}
    for tree, node, parent, role, text, score in rows:
        if node is None:
            continue
        value = ((parent is not None, parent), role or "", text or "", score or 0.0)
        if (tree, node) not in least or value < least[tree, node]:
            least[tree, node] = value
    parents = {(tree, value[0][1]) for (tree, _), value in least.items()}
    by_tree = {}
    for tree, node in least:
        path, at = [], node
        while at is not None and at not in path and (tree, at) in least:
            path.append(at)
            at = least[tree, at][0][1]
        if (tree, node) not in parents and not (at is not None and at in path):
            by_tree.setdefault(tree, []).append((-sum(least[tree, n][3] for n in path), node, path[::-1]))
    return {
        (tree, leaf): (rank, [least[tree, n][1:3] for n in path])
        for tree, found in by_tree.items()
        for rank, (_, leaf, path) in enumerate(sorted(found)[:branches], 1)
    }


@pytest.mark.parametrize("branches", [1, 3])
def test_paths_equal_walking_up(spark, branches):
    rng = random.Random(branches)
    rows = []
    for tree in [*range(12), None]:
        size = rng.choice([1, 2, 5, 40])
        for node in range(size):
            parent = rng.choice([None, *range(max(0, node - 4), node)]) if node else None
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None]), rng.choice([*HARD, None]), rng.choice([None, 0.0, 1.0, -2.5])))
    rows += [(50, 1, 2, "user", "cycle", 1.0), (50, 2, 1, "user", "cycle", 1.0), (50, 3, 2, "user", "below", 1.0), (50, 4, None, "user", "root", 1.0)]
    rows += [(51, 1, 99, "user", "its parent is missing", 1.0), (51, None, 1, "user", "no key", 1.0), (52, 7, 7, "user", "own parent", 1.0)]
    rows += [rows[3], rows[3], (0, 0, None, "a", "another text under one key", 0.0)]
    rows += [(60, n, n - 1 if n else None, "assistant" if n % 2 else "user", f"turn {n}", 1.0) for n in range(75)]
    template = replytrees.Template()
    got = replytrees.Trees(made(spark, rows), score="score").conversations(branches, template)
    want = brute(rows, branches)
    read = got.select("*", template.turns(got["formatted"]).alias("turns"), template.learned_texts(got["formatted"], got["loss"]).alias("learned")).collect()
    assert {(r.tree, r.leaf): (r.rank, [tuple(t) for t in r.turns]) for r in read} == want
    for row in read:
        assert row.n_turns == len(row.turns) and row.learned == [t.text for t in row.turns if t.role == "assistant"]
        assert len(row.loss) == len(row.learned) and all(row.formatted[s.end :].startswith("</turn>\n") for s in row.loss)


def test_empty_table(spark):
    rows = replytrees.Trees(made(spark, [])).conversations()
    assert rows.columns == ["tree", "leaf", "rank", "score", "n_turns", "formatted", "loss"] and rows.count() == 0


def test_chains_of_odd_conversations(spark):
    rows = [(1, 2, "user", "b"), (1, None, "user", "a"), (1, 2, "user", "b"), (None, 0, None, None), (None, 1, "assistant", ""), (2, 5, "x: y### ", "</turn>")]
    messages = spark.createDataFrame([(*row, 9) for row in rows], "conv_id bigint, turn bigint, role string, text string, node int")
    template = replytrees.Template()
    got = replytrees.Trees(replytrees.chained(messages)).conversations(1, template)
    read = {r.tree: [tuple(t) for t in r.turns] for r in got.select("tree", template.turns(got["formatted"]).alias("turns")).collect()}
    assert read == {1: [("user", "a"), ("user", "b"), ("user", "b")], None: [("", ""), ("assistant", "")], 2: [("x: y### ", "</turn>")]}


@pytest.mark.parametrize("marks", [{"head": "aa"}, {"end": "#"}, {"head": "<s>", "end": "></s"}, {"between": "x\\"}])
def test_marks_that_could_arise_from_texts_are_refused(marks):
    with pytest.raises(ValueError):
        replytrees.Template(**marks)


def test_query(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    said = {}
    for conv, turn, role, text in [*map(tuple, rows), (-7, 0, "user", PLANTED_TEXT), (-7, 1, "assistant", PLANTED_TEXT)]:
        said.setdefault(conv, []).append((turn, role, text or ""))
    got = QUERIES["op13_chat_formatting"](spark, data).collect()
    assert {row.conv_id for row in got} == set(said) and len(got) == len(said)
    for row in got:
        turns = sorted(said[row.conv_id])
        learned = "".join(text for _, role, text in turns if role == "assistant")
        assert row.n_turns == len(turns) and row.loss_chars == len(learned)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_query_runs_no_python(spark, data):
    plan = QUERIES["op13_chat_formatting"](spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
