"""Queries of the search client."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtext.operators import profile, search
from webtext.operators.index import Index
from webtext.plans import sql
from webtext.session import fresh_dir
from webtext.sources import collections as store

TEXT = "Worthless THING que der the"
TOKEN = "worthless"


def _documents(spark, folder):
    return store.table(spark, folder, "documents")


def _match(spark, folder):
    return search.match(store.scan(spark, folder, "documents"), "text", TEXT, "doc_id")


def _term(spark, folder):
    return search.term(store.scan(spark, folder, "documents"), "text", TOKEN, "doc_id")


def _index(spark, folder, segments: int = 1):
    """The documents as a written index, in one or more segments."""
    index = Index(spark, fresh_dir(spark, "index"))
    documents = store.scan(spark, folder, "documents")
    for i in range(segments):
        index.append(documents.filter(F.pmod("doc_id", F.lit(segments)) == i), "text", "doc_id")
    return index


def indexed_match_bm25(spark, folder):
    hits = _index(spark, folder).match(TEXT).top()
    return hits.select(F.col("key").alias("doc_id"), F.round("_score", 4).alias("score"))


def indexed_match_total(spark, folder):
    """Over two segments that are searched as they are."""
    return _index(spark, folder, 2).match(TEXT).total()


def indexed_merged_bm25(spark, folder):
    """Over segments that were merged."""
    index = _index(spark, folder, 3)
    index.merge()
    return index.match(TEXT).top().select(F.col("key").alias("doc_id"), F.round("_score", 4).alias("score"))


def indexed_term_total(spark, folder):
    return _index(spark, folder).term(TOKEN).total()


def sharded_articles(spark, folder):
    """Create a collection of pages with shards, append to it, and join it with one of equal shards by key."""
    name = uuid.uuid4().hex
    pages = store.table(spark, folder, "pages").select("page_id", "url")
    lengths = store.table(spark, folder, "pages").select("page_id", F.length("html").alias("html_chars"))
    first = F.col("page_id") % 2 == 0
    store.create_sharded(pages.filter(first), f"pages_{name}", "page_id", 8, fresh_dir(spark, "pages"))
    store.append_sharded(pages.filter(~first), f"pages_{name}", "page_id", 8)
    store.create_sharded(lengths, f"lengths_{name}", "page_id", 8, fresh_dir(spark, "lengths"))
    return spark.table(f"pages_{name}").hint("merge").join(spark.table(f"lengths_{name}"), "page_id")


def multi_scan_typed(spark, folder):
    """Collections whose ``id`` and ``size`` are numbers of two widths and text; what is no number is rescued."""
    third = F.col("page_id") % 3 == 0
    collections = {
        "log-events": store.table(spark, folder, "events").select(
            F.col("event_id").alias("id"), (F.col("event_id") % 1000).cast("int").alias("size"), F.col("event_type").alias("kind")
        ),
        "log-documents": _documents(spark, folder).select(F.col("doc_id").alias("id"), F.length("text").cast("long").alias("size"), "lang"),
        "log-pages": store.table(spark, folder, "pages").select(
            F.when(third, F.concat(F.lit("p"), "page_id")).otherwise(F.col("page_id").cast("string")).alias("id"),
            F.when(third, F.lit("?")).otherwise(F.length("html").cast("string")).alias("size"),
        ),
        "other": store.table(spark, folder, "pages"),
    }
    typed = store.scan_typed(collections, "log-", {"id": T.LongType(), "size": T.LongType()})
    return typed.withColumn("_rescued", F.to_json("_rescued"))


def _scored(hits):
    return hits.withColumn("score", F.round("_score", 4)).drop("_score")


def _collections(spark, folder):
    return {name: store.table(spark, folder, name) for name in ("documents", "conversations", "benchmark")}


QUERIES = {
    "export_all": lambda spark, folder: _documents(spark, folder),
    "multi_scan_total": lambda spark, folder: store.scan_all(_collections(spark, folder)).agg(
        F.count("*").alias("total")
    ),
    "multi_scan_counts": lambda spark, folder: store.scan_all(_collections(spark, folder))
    .groupBy("_index")
    .agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")),
    "match_all_total": lambda spark, folder: search.match_all(_documents(spark, folder), "doc_id").total(),
    "match_all_top10": lambda spark, folder: search.match_all(_documents(spark, folder), "doc_id").top(),
    "match_bm25": lambda spark, folder: _scored(_match(spark, folder).top()).select("doc_id", "score"),
    "match_total": lambda spark, folder: _match(spark, folder).total(),
    "match_hits_json": lambda spark, folder: _scored(_match(spark, folder).sources()),
    "term_hits": lambda spark, folder: _scored(_term(spark, folder).top()).select("doc_id", "lang", "score"),
    "term_total": lambda spark, folder: _term(spark, folder).total(),
    "term_keyword_total": lambda spark, folder: search.term(
        _documents(spark, folder), "lang", "de", "doc_id", analysed=False
    ).total(),
    "indexed_match_bm25": indexed_match_bm25,
    "indexed_match_total": indexed_match_total,
    "indexed_merged_bm25": indexed_merged_bm25,
    "indexed_term_total": indexed_term_total,
    "sharded_articles": sharded_articles,
    "multi_scan_typed": multi_scan_typed,
    "head5": lambda spark, folder: profile.head(_documents(spark, folder), "doc_id"),
}


def _scores_sql(terms: list[str]) -> str:
    listed = ", ".join(sql.quote(term) for term in terms)
    return f"""
tok AS (SELECT doc_id, {sql.search_tokens('text')} AS t FROM documents WHERE text IS NOT NULL),
corpus AS (SELECT count(*) AS n, avg(len(t)) AS mean_length FROM tok),
hit AS (
  SELECT doc_id, any_value(dl) AS dl, term, count(*) AS tf
  FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM tok) WHERE term IN ({listed}) GROUP BY doc_id, term
),
freq AS (SELECT term, count(*) AS df FROM hit GROUP BY term),
scored AS (
  SELECT doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / mean_length))) AS score
  FROM hit JOIN freq USING (term), corpus GROUP BY doc_id
)"""


_MATCH = _scores_sql(sorted(set(TEXT.lower().split())))
_TERM = _scores_sql([TOKEN])
_TOP = "ORDER BY scored.score DESC, doc_id LIMIT 10"

SQL = {
    "export_all": "SELECT * FROM documents",
    "multi_scan_total": """SELECT ((SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations)
  + (SELECT count(*) FROM benchmark))::bigint AS total""",
    "multi_scan_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS _index, count(*) AS n, sum(length(text))::bigint AS chars FROM {name}"
        for name in ("documents", "conversations", "benchmark")
    ),
    "match_all_total": "SELECT count(*) AS total FROM documents",
    "match_all_top10": "SELECT *, 1.0::double AS _score FROM documents ORDER BY doc_id LIMIT 10",
    "match_bm25": f"WITH {_MATCH} SELECT doc_id, round(score, 4) AS score FROM scored {_TOP}",
    "match_total": f"WITH {_MATCH} SELECT count(*) AS total FROM scored",
    "match_hits_json": f"""WITH {_MATCH}
SELECT doc_id, to_json(struct_pack(doc_id := doc_id, text := text, lang := lang, source := source, n_chars := n_chars))::varchar
  AS _source, round(score, 4) AS score
FROM scored JOIN documents USING (doc_id) {_TOP}""",
    "term_hits": f"""WITH {_TERM}
SELECT doc_id, lang, round(score, 4) AS score FROM scored JOIN documents USING (doc_id) {_TOP}""",
    "term_total": f"WITH {_TERM} SELECT count(*) AS total FROM scored",
    "term_keyword_total": "SELECT count(*) AS total FROM documents WHERE lang = 'de'",
    "head5": "SELECT * FROM documents ORDER BY doc_id LIMIT 5",
}

SQL |= {
    "multi_scan_typed": """
SELECT event_id AS id, event_id % 1000 AS size, event_type AS kind, NULL::varchar AS lang, NULL::varchar AS _rescued, 'log-events' AS _index FROM events
UNION ALL SELECT doc_id, length(text), NULL, lang, NULL, 'log-documents' FROM documents
UNION ALL SELECT CASE WHEN page_id % 3 <> 0 THEN page_id END, CASE WHEN page_id % 3 <> 0 THEN length(html) END, NULL, NULL,
  CASE WHEN page_id % 3 = 0 THEN '{"id":"p' || page_id || '","size":"?"}' END, 'log-pages' FROM pages""",
    "sharded_articles": "SELECT page_id, url, length(html)::int AS html_chars FROM pages",
    "indexed_match_bm25": SQL["match_bm25"],
    "indexed_match_total": SQL["match_total"],
    "indexed_merged_bm25": SQL["match_bm25"],
    "indexed_term_total": SQL["term_total"],
}
