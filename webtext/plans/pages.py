"""Queries over fetched pages: records, links, text blocks, JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.functions import html
from webtext.operators import extract
from webtext.plans import sql
from webtext.sources import collections as store


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return store.scan(spark, folder, "pages")


def _records(spark: SparkSession, folder: str, profile=extract.PLAIN_PAGES) -> DataFrame:
    return extract.articles(_pages(spark, folder), profile, keys=("page_id",))


def _shown(records: DataFrame) -> DataFrame:
    return records.withColumn("errors", F.array_join("errors", ","))


def page_scan(spark, folder):
    return store.fetched_pages(store.table(spark, folder, "pages")).select("page_id", "url", F.length("html").alias("html_chars"))


def page_titles(spark, folder):
    return _records(spark, folder).select("page_id", "title")


def page_body(spark, folder):
    return _records(spark, folder).select("page_id", "content")


def page_articles(spark, folder):
    return _shown(_records(spark, folder))


def page_articles_tree(spark, folder):
    return _shown(_records(spark, folder, extract.PLAIN_PAGES_TREE))


def page_links(spark, folder):
    return extract.links(_pages(spark, folder))


def page_cards(spark, folder):
    found = extract.cards(
        _pages(spark, folder), extract.PLAIN_PAGES_TREE, ("page_id",), html.origin(F.col("url"))
    )
    return found.select("page_id", "pos", "title", "href", "link")


def article_json(spark, folder):
    return store.article_documents(_records(spark, folder), ("page_id",))


def article_lines(spark, folder):
    return extract.article_lines(_records(spark, folder)).select("page_id", "line")


def _escaped(text: Column) -> Column:
    for character, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(character), F.lit(reference))
    return text


def _site_page() -> Column:
    """A document set in the news site's layout, one paragraph per line."""
    paragraphs = F.array_join(
        F.transform(F.split("text", "\n"), lambda line: F.concat(F.lit("<p>"), _escaped(line), F.lit("</p>"))), "\n"
    )
    before = "".join(f"<div>{i}</div>" for i in range(8))
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"),
        F.concat_ws(" ", F.col("source"), F.col("doc_id")),
        F.lit('</title></head><body><span class="big article__announce-date"> '),
        F.concat(F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit(".03.2022")),
        F.lit('\n</span><div class="article__announce-authors">by <a class="author" href="/a"><b>'),
        F.col("lang"),
        F.lit('</b>, staff</a></div><div class="content"><main><section><h1>head</h1><div>' + before + "<div>\n"),
        paragraphs,
        F.lit("\n</div></div></section></main></div></body></html>"),
    )


def site_articles(spark, folder):
    documents = store.scan(spark, folder, "documents")
    pages = documents.select(
        "doc_id", F.concat(F.lit("https://site.test/n/"), F.col("doc_id")).alias("url"), _site_page().alias("html")
    )
    return _shown(extract.articles(pages, extract.NEWS_SITE, keys=("doc_id",)))


def _listing() -> Column:
    parts = [
        '<div class="card__inner"><h3>', F.col("source"), '</h3><a href="/n/', F.col("doc_id"), '">x</a></div>',
        '<div class="card__inner big"><h3>Two</h3><h3>', F.col("lang"), '</h3><a>none</a><a href="/b/', F.col("doc_id"),
        '">y</a></div><div class="card__inner"><h3>Three</h3></div><div class="other"><a href="/n/9">z</a></div>',
    ]
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def site_cards(spark, folder):
    pages = store.scan(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("https://"), F.col("lang"), F.lit(".test")).alias("url"), _listing().alias("html")
    )
    return extract.cards(pages, keys=("doc_id",)).select("doc_id", "pos", "title", "href", "link")


def site_card_errors(spark, folder):
    """Listings that break off in a last card: it is noted, the cards before it stay."""
    pages = store.scan(spark, folder, "documents").select(
        "doc_id",
        F.lit("https://site.test").alias("url"),
        F.concat(_listing(), F.lit('<div class="card__inner"><h3>Cut'), F.col("source")).alias("html"),
    )
    return extract.cards(pages, keys=("doc_id",)).groupBy("error").agg(
        F.count("*").alias("n_cards"), F.count("link").alias("n_links"), F.max("pos").alias("last_pos")
    )


QUERIES = {
    "page_scan": page_scan,
    "page_titles": page_titles,
    "page_body": page_body,
    "page_articles": page_articles,
    "page_articles_tree": page_articles_tree,
    "page_links": page_links,
    "page_cards": page_cards,
    "article_json": article_json,
    "article_lines": article_lines,
    "site_articles": site_articles,
    "site_cards": site_cards,
    "site_card_errors": site_card_errors,
}

_TITLE = sql.unescape(sql.one_space("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))
_PARAGRAPH = sql.one_space("regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')")
_BODY = sql.unescape(
    "array_to_string(list_transform(string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')[2:], "
    f"lambda x: {_PARAGRAPH}), '')"
)
_ARTICLES = f"articles AS (SELECT page_id, url, {_TITLE} AS title, {_BODY} AS content FROM pages)"

ARTICLES_SQL = f"""WITH {_ARTICLES}
SELECT page_id, title, url, NULL::varchar AS author, NULL::varchar AS "dateTime", content,
  '' AS errors FROM articles"""

LINKS_SQL = rf"""
SELECT page_id, url, pos::int AS pos, href, regexp_extract(url, '^[a-z]+://[^/?#]+') || href AS link FROM (
  SELECT page_id, url, unnest(range(len(l))) AS pos, {sql.unescape('unnest(l)', attribute=True)} AS href
  FROM (SELECT *, regexp_extract_all(html, '<a\s+href="([^"]*)"', 1) AS l FROM pages)
)"""

SQL = {
    "page_scan": "SELECT page_id, url, length(html)::int AS html_chars FROM pages WHERE html IS NOT NULL",
    "page_titles": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "page_body": f"SELECT page_id, {_BODY} AS content FROM pages",
    "page_articles": ARTICLES_SQL,
    "page_articles_tree": ARTICLES_SQL,
    "page_links": LINKS_SQL,
    "page_cards": f"""
SELECT page_id, pos::int AS pos, title, href, regexp_extract(url, '^[a-z]+://[^/?#]+') || href AS link FROM (
  SELECT page_id, url, unnest(range(len(t))) AS pos, {sql.unescape('unnest(t)')} AS title,
    {sql.unescape('unnest(h)', attribute=True)} AS href
  FROM (SELECT *, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS h,
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS t FROM pages)
)""",
    "article_json": f"""WITH {_ARTICLES}
SELECT page_id, '{{"url":' || to_json(url)::varchar || ',"title":' || to_json(title)::varchar ||
  ',"content":' || to_json(content)::varchar || '}}' AS _source FROM articles""",
    "article_lines": f"""WITH {_ARTICLES}
SELECT page_id, 'null, null ' || chr(10) || title || ': ' || url || ' ' || chr(10) || content AS line FROM articles""",
    "site_articles": rf"""
SELECT doc_id, source || ' ' || doc_id AS title, 'https://site.test/n/' || doc_id AS url, lang AS author,
  lpad((doc_id % 28 + 1)::varchar, 2, '0') || '.03.2022' AS "dateTime",
  array_to_string(list_transform(string_split(text, chr(10)), lambda x: {sql.one_space('x')}), '') AS content,
  '' AS errors FROM documents""",
    "site_cards": """
SELECT doc_id, 0 AS pos, source AS title, '/n/' || doc_id AS href, 'https://' || lang || '.test/n/' || doc_id AS link
FROM documents
UNION ALL SELECT doc_id, 1, 'Two ' || lang, '/b/' || doc_id, 'https://' || lang || '.test/b/' || doc_id FROM documents
UNION ALL SELECT doc_id, 2, 'Three', '', 'https://' || lang || '.test' FROM documents""",
    "site_card_errors": """
SELECT NULL::varchar AS error, 3 * count(*) AS n_cards, 3 * count(*) AS n_links, 2 AS last_pos FROM documents
UNION ALL SELECT 'unclosed', count(*), 0, 3 FROM documents""",
}
