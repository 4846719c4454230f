"""Articles and links from fetched pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtext.functions import elements, html

ARTICLE_FIELDS = ["title", "url", "author", "dateTime", "content"]

ARTICLE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ARTICLE_FIELDS]
    + [T.StructField("errors", T.ArrayType(T.StringType()))]
)


@dataclass(frozen=True)
class PatternProfile:
    """Where the fields are, as regular expressions; a field without one is always missing."""

    content: str = html.ARTICLE
    date_time: str | None = None
    author: str | None = None


@dataclass(frozen=True)
class TreeProfile:
    """Where the fields are, as paths of selectors and child positions (see ``elements.locate``).

    Content is the text of the children of ``content`` that match ``part`` (all if None), joined
    with no separator.
    """

    # Selectors and positions of the news site's layout.
    date_time: tuple | None = (".article__announce-date",)
    author: tuple | None = ("div.article__announce-authors", "a.author", 0)
    content: tuple = (".content", "main", "section", 1, 8)
    part: str | None = None
    card: str = ".card__inner"
    card_title: str = "h3"


PLAIN_PAGES = PatternProfile()
PLAIN_PAGES_TREE = TreeProfile(date_time=None, author=None, content=("article",), part="p", card="li", card_title="a")
NEWS_SITE = TreeProfile()


def _pattern_fields(pages: DataFrame, carried: list[str], profile: PatternProfile) -> DataFrame:
    """Three projections, so that each expensive step is computed once per page."""

    def field_markup(pattern):
        found = html.first_group(F.col("html"), pattern) if pattern else F.lit(None).cast("string")
        return html.strip_markup(found)

    cut = pages.select(
        *carried,
        F.col("html").isNotNull().alias("_fetched"),
        html.title_markup(F.col("html")).alias("title"),
        field_markup(profile.date_time).alias("dateTime"),
        field_markup(profile.author).alias("author"),
        html.mark_paragraphs(html.first_group(F.col("html"), profile.content)).alias("content"),
    )
    stripped = cut.withColumn("content", html.strip_markup(html.after_first_mark(F.col("content"))))
    return stripped.select(
        *carried,
        "_fetched",
        *[
            html.normalise_space(html.unescape(F.col(name))).alias(name)
            for name in ("title", "dateTime", "author")
        ],
        html.join_paragraphs(html.unescape(F.col("content"))).alias("content"),
    )


def _tree_fields(pages: DataFrame, carried: list[str], profile: TreeProfile) -> DataFrame:
    """The markup of each field first, then its text, so that an element is found once per page."""

    paths = {"title": ("title",), "dateTime": profile.date_time, "author": profile.author, "content": profile.content}
    source = pages.select(*carried, F.col("html").alias("_html"))
    located = elements.locate(source, {name: path for name, path in paths.items() if path}, "_html")
    fetched = F.col("_html").isNotNull()
    cut = located.select(
        *carried,
        fetched.alias("_fetched"),
        F.when(fetched, F.coalesce("title", F.lit(""))).alias("title"),
        *[
            (F.col(name) if paths[name] else F.lit(None).cast("string")).alias(name)
            for name in ("dateTime", "author", "content")
        ],
    )
    parts = F.transform(elements.children(F.col("content"), profile.part), elements.text)
    return cut.select(
        *carried,
        "_fetched",
        *[elements.text(F.col(name)).alias(name) for name in ("title", "dateTime", "author")],
        F.array_join(parts, "").alias("content"),
    )


def articles(
    pages: DataFrame,
    profile: PatternProfile | TreeProfile = PLAIN_PAGES,
    on_error: str = "keep",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Pages ``(url, html)`` to article records.

    A field that the profile defines and that is not there is NULL and named in ``errors``; a page that was not fetched
    (NULL ``html``) has the error ``html``. ``on_error='drop'`` keeps whole records only.
    ``keys`` are page columns to carry along. One narrow stage, no shuffle.
    """
    if on_error not in ("keep", "drop"):
        raise ValueError("on_error is 'keep' or 'drop'")
    fetched = F.col("html").isNotNull()
    source = pages.filter(fetched) if on_error == "drop" else pages
    carried = list(dict.fromkeys((*keys, "url")))

    fields = _pattern_fields if isinstance(profile, PatternProfile) else _tree_fields
    parsed = fields(source, carried, profile)

    asked = {"title": True, "dateTime": profile.date_time, "author": profile.author, "content": profile.content}
    missing = [F.when(F.col(name).isNull(), F.lit(name)) for name, wanted in asked.items() if wanted]
    errors = F.when(~F.col("_fetched"), F.array(F.lit("html"))).otherwise(F.array_compact(F.array(*missing)))
    extra = [key for key in keys if key not in ARTICLE_FIELDS]
    records = parsed.select(*extra, *ARTICLE_FIELDS, errors.alias("errors"))
    return records.filter(F.size("errors") == 0) if on_error == "drop" else records


def links(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), resolve: bool = False) -> DataFrame:
    """Every ``<a href="...">``, one row each, joined to the site the page came from."""
    return (
        pages.filter(F.col("html").isNotNull())
        .select(*keys, html.origin(F.col("url")).alias("_site"), F.posexplode_outer(html.hrefs(F.col("html"))))
        .filter(F.col("pos").isNotNull())
        .select(
            *keys,
            F.col("pos"),
            F.col("col").alias("href"),
            html.absolute(F.col("_site"), F.col("col"), resolve).alias("link"),
        )
    )


def dedupe_links(links: DataFrame, order: tuple[str, ...] = ("page_id", "pos"), link: str = "link") -> DataFrame:
    """One row per link, the one that is first by ``order``; other columns are those of that row."""
    others = [name for name in links.columns if name not in (*order, link)]
    first = links.groupBy(link).agg(F.min(F.struct(*order, *others)).alias("_first"))
    return first.select(link, *[F.col(f"_first.{name}").alias(name) for name in (*order, *others)])


def cards(
    pages: DataFrame,
    profile: TreeProfile = NEWS_SITE,
    keys: tuple[str, ...] = ("url",),
    site: Column | None = None,
    resolve: bool = False,
) -> DataFrame:
    """Cards of a listing page: title, first link that has a target, and the absolute link.

    A card without a link yields the bare site. A card that the page breaks off in has the ``error``
    ``unclosed`` and no title or link; the others are not affected.
    """
    site = F.col("url") if site is None else site
    titles = F.transform(elements.select(F.col("_card.markup"), profile.card_title), elements.text)
    shown = F.regexp_replace("_card.markup", elements.HIDDEN, "")
    return (
        pages.select(
            *keys,
            site.alias("_site"),
            F.posexplode_outer(elements.select_marked(F.col("html"), profile.card)).alias("pos", "_card"),
        )
        .filter(F.col("pos").isNotNull())
        .select(
            *keys,
            "_site",
            "pos",
            F.when(F.col("_card.closed"), F.array_join(titles, " ")).alias("title"),
            F.when(F.col("_card.closed"), F.coalesce(F.get(html.hrefs(shown), F.lit(0)), F.lit(""))).alias("href"),
            F.when(~F.col("_card.closed"), F.lit("unclosed")).alias("error"),
        )
        .select(
            *keys,
            "pos",
            "title",
            "href",
            F.when(F.col("error").isNull(), html.absolute(F.col("_site"), F.col("href"), resolve)).alias("link"),
            "error",
        )
    )


#: Fixed value: the layout of an article printed as text.
LINE_FORMAT = "%s, %s \n%s: %s \n%s"


def article_lines(records: DataFrame) -> DataFrame:
    """Records as text blocks; a missing value prints as ``null``."""
    shown = [F.coalesce(F.col(name), F.lit("null")) for name in ("author", "dateTime", "title", "url", "content")]
    return records.withColumn("line", F.format_string(LINE_FORMAT, *shown))
