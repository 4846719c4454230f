"""The written index beside the search that scans."""

from __future__ import annotations

import random
import shutil
from collections import Counter
from pathlib import Path

import pytest

from webtext.operators import index as indexes
from webtext.operators import search
from webtext.operators.index import Index

WORDS = [f"w{i}" for i in range(40)]


def made(spark, rows):
    return spark.createDataFrame(rows, "id string, text string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(WORDS[: rng.choice([3, 10, 40])]) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["w0 w39", "w0 w39"] * 8 + [None, "", "?!", "W0 É日本 w1 " * 50]
    return [(f"k{i:04}", text) for i, text in enumerate(texts)]


@pytest.fixture(scope="module")
def built(spark, rows, tmp_path_factory):
    """Many small ranges, blocks and segments."""
    kept = indexes.RANGE_BITS, indexes.RANGE, indexes.BLOCK
    indexes.RANGE_BITS, indexes.RANGE, indexes.BLOCK = 4, 16, 5
    index = Index(spark, str(tmp_path_factory.mktemp("index") / "i"), 8)
    for part in (rows[:150], rows[150:160], rows[160:]):
        index.append(made(spark, part).repartition(3), "text", "id")
    yield index
    indexes.RANGE_BITS, indexes.RANGE, indexes.BLOCK = kept


def shown(frame):
    return [(row[0], round(row[1], 9)) for row in frame.collect()]


QUERIES = ["w0", "w39 w2", "w5 w5 w30", "É日本", "unknown", "w1 unknown", " ".join(WORDS)]


@pytest.mark.parametrize("text", QUERIES)
def test_equals_the_scan(spark, rows, built, text):
    scan = search.match(made(spark, rows), "text", text, "id")
    found = built.match(text)
    assert found.total().collect() == scan.total().collect()
    for size in (3, 1000):
        assert shown(found.top(size)) == shown(scan.top(size).select("id", "_score"))


def test_term_is_not_analysed(built):
    assert built.term("w0").total().first()["total"] > 0
    assert built.term("W0").total().first()["total"] == 0 and built.term("w0 w1").top().collect() == []


def test_merged_segments_give_the_same(spark, rows, tmp_path):
    index = Index(spark, str(tmp_path / "i"), 4)
    for i in range(3):
        index.append(made(spark, rows[i::3]), "text", "id")
    before = [shown(index.match(text).top(20)) for text in QUERIES[1:4]]
    names = {row["segment"] for row in index.segments()}
    merged = index.merge()
    assert len(names) == 3 and [row["segment"] for row in index.segments()] == [merged]
    assert [shown(index.match(text).top(20)) for text in QUERIES[1:4]] == before
    index.append(made(spark, [("new", "w0 fresh")]), "text", "id")
    assert shown(index.match("fresh").top())[0][0] == "new"


def test_only_the_tokens_buckets_are_read(built, tmp_path):
    """A copy that holds no other bucket answers alike, and the plan prunes by bucket."""
    found = built.match("w39 w2")
    wanted = {row["bucket"] for row in found.blocks.select("bucket").distinct().collect()}
    copy = tmp_path / "copy"

    def others(folder, names):
        return [name for name in names if name.startswith("bucket=") and int(name[7:]) not in wanted]

    shutil.copytree(built.path, copy, ignore=others)
    kept = {path.name for path in Path(copy).glob("postings/*/bucket=*")}
    assert len(kept) == len(wanted) < 8
    assert shown(Index(built.spark, str(copy)).match("w39 w2").top()) == shown(found.top())
    built.spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = Index(built.spark, built.path).match("w39 w2").blocks._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    built.spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "bucket" in partition and "segment" in partition and "In(token" in plan


def test_bounds_hold_and_ranges_are_skipped(built):
    found = built.match("w39 w2")
    bounds = {(row["segment"], row["range"]): row["bound"] for row in found.bounds().collect()}
    scores = found._scored(found.bounds().select("segment", "range")).collect()
    for row in scores:
        assert row["_score"] <= bounds[row["segment"], row["number"] >> indexes.RANGE_BITS] * (1 + 1e-9)
    least = sorted((row["_score"] for row in scores), reverse=True)[0]
    assert sum(bound >= least for bound in bounds.values()) < len(bounds)


def test_a_frequent_token_is_many_groups(built):
    blocks = built.postings().filter("token = 'w0'").collect()
    held = Counter()
    for row in blocks:
        held[row["segment"]] += row["n"]
    blocks = [row for row in blocks if held[row["segment"]] > 16]
    assert all(row["n"] <= 5 and row["last"] - row["first"] < 16 for row in blocks) and len(blocks) > 10


def test_a_build_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    index = Index(spark, str(tmp_path / "i"))
    with pytest.raises(ValueError, match="no segments"):
        index.match("a").total()
    index.append(made(spark, [("a", "one two")]), "text", "id")
    monkeypatch.setattr(Index, "_buckets", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.append(made(spark, [("b", "one")]), "text", "id")
    monkeypatch.undo()
    assert shown(index.match("one").top())[0][0] == "a" and index.match("one").total().first()["total"] == 1


def test_empty_documents(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"))
    index.append(made(spark, []), "text", "id")
    assert index.match("a").total().first()["total"] == 0 and index.match("a b").top().collect() == []
