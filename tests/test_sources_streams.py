import json

import pytest
from pyspark.sql import functions as F

from webtext import session
from webtext.operators import extract
from webtext.sources import collections as store
from webtext.sources import queue
from webtext.streaming import batches, jobs

from test_extract import LISTING, article


def test_article_documents_leave_missing_fields_out(spark):
    records = spark.createDataFrame([("t", "u", None, None, 'c "q"\n', ["author"])], extract.ARTICLE_SCHEMA)
    assert json.loads(store.article_documents(records).first()["_source"]) == {"url": "u", "title": "t", "content": 'c "q"\n'}


def test_append_is_no_upsert(spark, tmp_path):
    path = str(tmp_path / "articles")
    records = spark.createDataFrame([("t", "u", "a", "d", "c", [])], extract.ARTICLE_SCHEMA)
    store.append_articles(records, path)
    store.append_articles(records, path, shards=1)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(path).columns == extract.ARTICLE_FIELDS


def test_create_collection_at_a_path(spark, tmp_path):
    path = str(tmp_path / "c")
    for _ in range(2):
        store.create_collection(spark, "site_pages", extract.ARTICLE_SCHEMA, path)
    store.append(spark.createDataFrame([("t", "u", "a", "d", "c", [])], extract.ARTICLE_SCHEMA), path)
    spark.catalog.refreshTable("site_pages")
    assert spark.table("site_pages").count() == 1
    spark.sql("DROP TABLE site_pages")


def test_scan_all(spark):
    a = spark.createDataFrame([(1, "x")], "id int, text string")
    b = spark.createDataFrame([("y",)], "text string")
    both = store.scan_all({"logs-a": a, "logs-b": b, "other": b}, "logs-")
    assert {tuple(r) for r in both.select("_index", "id", "text").collect()} == {("logs-a", 1, "x"), ("logs-b", None, "y")}
    with pytest.raises(ValueError):
        store.scan_all({"a": a}, "q")


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")
    assert session.fresh_dir(spark, "x") != session.fresh_dir(spark, "x")
    df = session.materialise(spark.range(5), "numbers")
    assert df.count() == 5 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_scans_of_one_split_are_spread_and_larger_ones_left_alone(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert "RoundRobin" in session.spread(df, path)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert session.spread(df, path) is df
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [session._bytes(x) for x in ("134217728b", "16m", "1G", "64kb", "12")] == [1 << 27, 1 << 24, 1 << 30, 1 << 16, 12]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    def on(master, folder=None):
        settings = SimpleNamespace(get=lambda name, default=None: default)
        context = SimpleNamespace(master=master, applicationId="app-1", getConf=lambda: settings, getCheckpointDir=lambda: folder)
        return SimpleNamespace(conf=settings, sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(on("spark://host:7077"))
    assert session.shared_dir(on("yarn", "hdfs://x/ck/")) == "hdfs://x/ck"
    assert session.shared_dir(on("local[4]"))


def test_crawl_from_listing_to_articles(spark, tmp_path):
    """Discover, queue, consume, parse: the whole chain, and a second run adds nothing."""
    path = {n: str(tmp_path / n) for n in ("listing", "queue", "articles", "ck1", "ck2")}
    spark.createDataFrame([(1, "https://site.test", LISTING)], jobs.PAGE).write.parquet(path["listing"])
    fetched = spark.createDataFrame([("https://site.test/n/1", article())], "url string, html string")
    store.write_buckets(fetched, str(tmp_path / "held"), "url", 4)
    for _ in range(2):
        jobs.run_once(jobs.discover_cards(jobs.read_pages(spark, path["listing"])), path["queue"], path["ck1"])
        batches.run_messages(queue.consume(spark, path["queue"]), str(tmp_path / "held"), 4, path["articles"], path["ck2"], extract.NEWS_SITE)
        rows = {r["url"]: r for r in spark.read.parquet(path["articles"]).collect()}
        assert len(rows) == spark.read.parquet(path["articles"]).count() == 3
    assert rows["https://site.test/n/1"]["content"] == "одиндва"
    assert rows["https://site.test/n/2"]["errors"] == ["html"] and rows["https://site.test"]["errors"] == ["html"]


def test_new_files_are_taken_once(spark, tmp_path):
    waiting, output, checkpoint = (str(tmp_path / n) for n in ("queue", "out", "ck"))
    for start in (1, 11):
        messages = spark.createDataFrame([(f"test {i}",) for i in range(start, start + 10)], queue.MESSAGE)
        queue.publish(messages, waiting)
        jobs.run_once(queue.consume(spark, waiting), output, checkpoint)
    assert sorted(r["url"] for r in spark.read.parquet(output).collect()) == sorted(f"test {i}" for i in range(1, 21))


def test_stream_equals_batch(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    stream = jobs.read_pages(spark, data, pattern="pages.parquet")
    for name, transform in (("links", jobs.discover_links), ("articles", jobs.parse_pages)):
        output = str(tmp_path / name)
        jobs.run_once(transform(stream), output, str(tmp_path / f"{name}-ck"))
        batch = transform(pages)
        written = spark.read.parquet(output).select(*batch.columns)
        assert written.count() == batch.count() > 0 and written.exceptAll(batch).count() == 0


def test_line_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("one\ntwo\n")
    output = str(tmp_path / "out")
    jobs.run_once(jobs.read_lines(spark, str(tmp_path / "in"), ("t",)), output, str(tmp_path / "ck"), ("date",))
    assert sorted(r["message"] for r in spark.read.parquet(output).collect()) == ["one", "two"]
