"""Streams on folders of files, pruned joins, acknowledgement, late rows, de-duplication, sharded tables."""

from __future__ import annotations

import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from webtext.operators import extract
from webtext.plans import registry
from webtext.sources import collections as store
from webtext.streaming import batches, jobs

STREAMS = ["stream_links", "stream_articles", "stream_messages", "stream_rerun", "stream_acknowledged", "stream_links_deduped", "stream_time_buckets"]


@pytest.fixture(scope="module")
def parts(spark, data, tmp_path_factory):
    """The tables as folders of part files, as Spark writes them."""
    folder = tmp_path_factory.mktemp("parts")
    for name in ("pages", "events"):
        spark.read.parquet(f"{data}/{name}.parquet").repartition(3).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", STREAMS)
def test_streams_read_folders_of_files(spark, data, parts, name):
    assert sorted(map(repr, registry.QUERIES[name](spark, parts).collect())) == sorted(map(repr, registry.QUERIES[name](spark, data).collect()))


def test_a_batch_reads_only_its_buckets(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    held = str(tmp_path / "held")
    store.write_buckets(pages, held, "url", 16)
    wanted = pages.select("url").limit(2)
    found = store.read_buckets(spark, held, wanted, "url", 16)
    files = {row[0] for row in found.select(F.input_file_name()).distinct().collect()}
    folders = {Path(file).parent.name for file in files}
    assert 1 <= len(folders) <= 2 < len(list(Path(held).glob("bucket=*")))

    # The same from a copy without the other folders.
    shutil.copytree(held, tmp_path / "some", ignore=lambda _, names: [n for n in names if n.startswith("bucket=") and n not in folders])
    urls = [row["url"] for row in wanted.collect()] + ["https://nowhere.test/"]
    messages = spark.createDataFrame([(url,) for url in urls], "url string")
    rows = {r["url"]: r["errors"] for r in batches.parse_messages(messages.filter("url <> 'https://nowhere.test/'"), str(tmp_path / "some"), 16).collect()}
    assert rows == {url: [] for url in urls[:2]}
    assert {r["url"]: r["errors"] for r in batches.parse_messages(messages, held, 16).collect()}[urls[2]] == ["html"]
    assert store.read_buckets(spark, held, wanted.limit(0), "url", 16).count() == 0


def _queue(spark, folder, fails, tries=3):
    def work(messages):
        return messages.withColumn("errors", F.when(F.col("id") % fails == 0, F.array(F.lit("no"))).otherwise(F.array().cast("array<string>")))

    return batches.Acknowledged(spark, spark.range(0).schema, str(folder), work, tries)


def test_messages_end_once(spark, tmp_path):
    queue = _queue(spark, tmp_path / "q", 4)
    for begin in (0, 10):
        queue.publish(spark.range(begin, begin + 10))
        queue.drain()
    done, dead = (sorted(row["id"] for row in rows.collect()) for rows in (queue.done(), queue.dead()))
    assert dead == [0, 4, 8, 12, 16] and done == [i for i in range(20) if i % 4]
    assert {row["tries"] for row in queue.dead().collect()} == {3} and queue.dead().first()["errors"] == ["no"]
    queue.drain()
    assert queue.done().count() + queue.dead().count() == 20


@pytest.mark.parametrize("place", range(4))
def test_a_batch_that_breaks_anywhere_counts_once(spark, tmp_path, monkeypatch, place):
    queue = _queue(spark, tmp_path / "q", 3, tries=2)
    queue.publish(spark.range(9))
    put, calls = batches.put, []

    def breaking(*args):
        calls.append(args)
        if len(calls) == place + 1:
            raise RuntimeError("broken here")
        put(*args)

    monkeypatch.setattr(batches, "put", breaking)
    with pytest.raises(Exception, match="broken here"):
        queue.drain()
    queue.drain()
    assert sorted(row["id"] for row in queue.done().collect()) == [1, 2, 4, 5, 7, 8]
    assert sorted(row["id"] for row in queue.dead().collect()) == [0, 3, 6]


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    feeds = [[0, 5, 59, 70], [130, 61, 20, 200], [199, 139, 140, 30, 300]]  # minutes; the mark is the latest before, less an hour
    for i, minutes in enumerate(feeds):
        spark.createDataFrame([(day + dt.timedelta(minutes=m),) for m in minutes] + [(None,)], "ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}"))
        events = spark.readStream.schema("ts timestamp").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        batches.run_time_buckets(events, str(tmp_path / "out"))
    late = sorted((row["ts"] - day).total_seconds() / 60 for row in spark.read.parquet(str(tmp_path / "out" / "late")).collect())
    assert late == [30, 139]  # the first mark is 10, the second 140
    got = {(row["bucket"] - day).total_seconds() / 3600: row["events"] for row in batches.read_time_buckets(spark, str(tmp_path / "out")).collect() if row["bucket"]}
    assert got == {0: 4, 1: 2, 2: 2, 3: 2, 5: 1}


def test_links_seen_before_are_dropped_and_leave_the_state(spark, tmp_path):
    seen, start = [], dt.datetime(2024, 1, 1)
    for i in range(8):
        rows = [(start + dt.timedelta(hours=5 * i), f"l{i}"), (start + dt.timedelta(hours=5 * i), f"l{max(0, i - 1)}")] * 2
        spark.createDataFrame(rows, "ts timestamp, link string").coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}"))
        links = spark.readStream.schema("ts timestamp, link string").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        query = jobs.start(batches.first_links(links, "ts", "6 hours"), str(tmp_path / "out"), str(tmp_path / "ck"))
        query.awaitTermination()
        seen += [progress["stateOperators"][0]["numRowsTotal"] for progress in query.recentProgress if progress["stateOperators"]]
    assert sorted(row["link"] for row in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"l{i}" for i in range(8)]
    assert max(seen) <= 4


def test_deduped_links_keep_the_first_place(spark):
    rows = [(2, 0, "a", "x"), (1, 3, "a", "y"), (1, 1, "b", "z"), (1, 1, "b", "z")]
    links = spark.createDataFrame(rows, "page_id int, pos int, link string, href string")
    assert sorted(map(tuple, extract.dedupe_links(links).select("page_id", "pos", "link", "href").collect())) == [(1, 1, "b", "z"), (1, 3, "a", "y")]


def test_sharded_tables_join_without_exchange(spark, data):
    joined = registry.QUERIES["sharded_articles"](spark, data)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 50


def test_a_sharded_collection_is_created_once(spark, tmp_path):
    for _ in range(2):
        store.create_sharded(spark.range(5), "sharded_numbers", "id", 4, str(tmp_path / "t"))
    store.append_sharded(spark.range(5, 8), "sharded_numbers", "id", 4)
    assert sorted(row["id"] for row in spark.table("sharded_numbers").collect()) == list(range(8))
    spark.sql("DROP TABLE sharded_numbers")
