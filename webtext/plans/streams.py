"""Streaming jobs run to the end of the waiting input; the result is what the sink holds."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from webtext.operators import extract
from webtext.plans import logs as log_plans
from webtext.plans import pages as page_plans
from webtext.session import fresh_dir
from webtext.sources import collections as store
from webtext.sources import queue
from webtext.streaming import batches, jobs

BUCKETS = 16


def _page_stream(spark, folder):
    return jobs.read_table(spark, folder, "pages")


def stream_links(spark, folder):
    output, checkpoint = fresh_dir(spark, "links"), fresh_dir(spark, "links-done")
    jobs.run_once(jobs.discover_links(_page_stream(spark, folder)), output, checkpoint)
    return spark.read.parquet(output)


def stream_articles(spark, folder):
    output, checkpoint = fresh_dir(spark, "articles"), fresh_dir(spark, "articles-done")
    jobs.run_once(jobs.parse_pages(_page_stream(spark, folder), keys=("page_id",)), output, checkpoint)
    return page_plans._shown(spark.read.parquet(output))


def stream_messages(spark, folder):
    """Publish page addresses to a queue, consume it, parse the page of each message from bucketed pages."""
    waiting, held, output, checkpoint = (fresh_dir(spark, name) for name in ("queue", "pages", "parsed", "parsed-done"))
    pages = store.scan(spark, folder, "pages")
    store.write_buckets(pages.select("url", "html"), held, "url", BUCKETS)
    queue.publish(pages.select("url"), waiting)
    batches.run_messages(queue.consume(spark, waiting), held, BUCKETS, output, checkpoint)
    return page_plans._shown(spark.read.parquet(output).drop("batch"))


class BrokenBatch(Exception):
    """What ends the first run of ``stream_acknowledged``."""


def stream_acknowledged(spark, folder):
    """Each message once, as done or as a dead letter, with its tries.

    One page in seven never parses, one in five fails its first try, and the first run breaks after a part of
    its first batch is written.
    """
    pages = store.scan(spark, folder, "pages").select("page_id", "url")

    def work(messages):
        fails = (F.col("page_id") % 7 == 0) | ((F.col("page_id") % 5 == 0) & (F.col("tries") == 0))
        return messages.withColumn("errors", F.when(fails, F.array(F.lit("parse"))).otherwise(F.array().cast("array<string>")))

    acknowledged = batches.Acknowledged(spark, pages.schema, fresh_dir(spark, "messages"), work)
    acknowledged.publish(pages)

    def broken(messages, batch):
        batches.put(work(messages).withColumn("tries", F.lit(1)).drop("errors"), f"{acknowledged.folder}/done", batch)
        raise BrokenBatch("after a part of the batch is written")

    first = spark.readStream.schema("page_id bigint, url string, tries int").option("recursiveFileLookup", "true").parquet(acknowledged.queue)
    try:
        batches.run(first, broken, f"{acknowledged.folder}/checkpoint")
    except StreamingQueryException as error:
        if BrokenBatch.__name__ not in str(error):
            raise
    acknowledged.drain()
    ends = {"done": acknowledged.done(), "dead": acknowledged.dead()}
    shown = [rows.select("page_id", "tries", F.lit(name).alias("outcome")) for name, rows in ends.items()]
    return shown[0].union(shown[1])


def links_deduped(spark, folder):
    return extract.dedupe_links(extract.links(store.scan(spark, folder, "pages"))).select("link")


def stream_links_deduped(spark, folder):
    """Links not seen before; pages count as fetched one second after the other."""
    output, checkpoint = fresh_dir(spark, "links"), fresh_dir(spark, "links-done")
    pages = _page_stream(spark, folder).withColumn("fetched", F.timestamp_seconds(F.col("page_id") + 1_700_000_000))
    links = jobs.discover_links(pages, ("page_id", "url", "fetched"))
    jobs.run_once(batches.first_links(links, "fetched", "365 days").select("link"), output, checkpoint)
    return spark.read.parquet(output)


def stream_time_buckets(spark, folder):
    """Both collections of ``time_buckets`` as one stream."""
    output = fresh_dir(spark, "buckets")
    events = jobs.read_table(spark, folder, "events", store.table(spark, folder, "events").schema).select("ts")
    batches.run_time_buckets(events.union(events), output)
    return batches.read_time_buckets(spark, output)


def stream_rerun(spark, folder):
    """Rows in the sink after a first and a second run with the same checkpoint."""
    output, checkpoint = fresh_dir(spark, "rerun"), fresh_dir(spark, "rerun-done")
    after = []
    for _ in range(2):
        jobs.run_once(jobs.discover_links(_page_stream(spark, folder)), output, checkpoint)
        after.append(spark.read.parquet(output).count())
    return spark.createDataFrame(list(enumerate(after, start=1)), "run int, rows long")


def stream_lines(spark, folder):
    files, output, checkpoint = (fresh_dir(spark, name) for name in ("lines", "events", "events-done"))
    log_plans.event_lines(spark, folder).select("value").write.text(files)
    jobs.run_once(jobs.read_lines(spark, files, ("demo",)), output, checkpoint, ("date",))
    return spark.read.parquet(output).select("message", F.array_join("tags", ",").alias("tags"))


QUERIES = {
    "stream_links": stream_links,
    "stream_articles": stream_articles,
    "stream_messages": stream_messages,
    "stream_rerun": stream_rerun,
    "stream_lines": stream_lines,
    "stream_acknowledged": stream_acknowledged,
    "links_deduped": links_deduped,
    "stream_links_deduped": stream_links_deduped,
    "stream_time_buckets": stream_time_buckets,
}

SQL = {
    "stream_links": page_plans.LINKS_SQL,
    "stream_articles": page_plans.ARTICLES_SQL,
    "stream_messages": f"SELECT * EXCLUDE (page_id) FROM ({page_plans.ARTICLES_SQL})",
    "stream_rerun": r"""
SELECT run::int AS run, (SELECT sum(len(regexp_extract_all(html, '<a\s+href="([^"]*)"'))) FROM pages)::bigint AS rows
FROM range(1, 3) r(run)""",
    "stream_lines": log_plans.SQL["line_ingest"],
    "stream_acknowledged": """
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 3 WHEN page_id % 5 = 0 THEN 2 ELSE 1 END AS tries,
  CASE WHEN page_id % 7 = 0 THEN 'dead' ELSE 'done' END AS outcome FROM pages""",
    "links_deduped": f"SELECT DISTINCT link FROM ({page_plans.LINKS_SQL})",
    "stream_links_deduped": f"SELECT DISTINCT link FROM ({page_plans.LINKS_SQL})",
    "stream_time_buckets": log_plans.SQL["time_buckets"],
}
