import html as stdlib

import pytest
from pyspark.sql import functions as F

from tests import tree as dom
from webtext.functions import elements, html
from webtext.operators import extract

LISTING = """
<div class="card__inner"><h3>One</h3><a href="/n/1">x</a></div>
<div class="card__inner big"><h3>Two</h3><h3>More</h3><a>no href</a><a href="/n/2">y</a></div>
<div class="card__inner"><h3>Three</h3></div>
<div class="other"><a href="/n/9">z</a></div>
"""


def article(author='<a class="author"><b>Ann  Lee</b></a>', gap="", ninth=None):
    ninth = f"<div><p>один</p>{gap}<p>два</p></div>" if ninth is None else ninth
    return (
        "<html><head><title> A &amp; B\n c</title></head><body>"
        '<span class="article__announce-date">21.03.2022</span>'
        f'<div class="article__announce-authors">{author}</div>'
        '<div class="content"><main><section><h1>t</h1><div>'
        + "<i>n</i>" * 8
        + ninth
        + "</div></section></main></div></body></html>"
    )


def parse(spark, markup, **options):
    pages = spark.createDataFrame([("u", markup)], "url string, html string")
    return [r.asDict() for r in extract.articles(pages, extract.NEWS_SITE, **options).collect()]


def test_listing_cards(spark):
    pages = spark.createDataFrame([("https://site.test", LISTING), ("https://x.test", None)], "url string, html string")
    rows = extract.cards(pages).orderBy("pos").collect()
    assert [(r["title"], r["href"], r["link"], r["error"]) for r in rows] == [
        ("One", "/n/1", "https://site.test/n/1", None),
        ("Two More", "/n/2", "https://site.test/n/2", None),
        ("Three", "", "https://site.test", None),
    ]


@pytest.mark.parametrize("gap", ["", "\n  ", " text that is no element "])
def test_article(spark, gap):
    assert parse(spark, article(gap=gap)) == [
        {
            "title": "A & B c",
            "url": "u",
            "author": "Ann Lee",
            "dateTime": "21.03.2022",
            "content": "одиндва",
            "errors": [],
        }
    ]


def test_missing_parts(spark):
    row = parse(spark, article(author=""))[0]
    assert row["author"] is None and row["errors"] == ["author"] and row["content"] == "одиндва"
    row = parse(spark, "<p>nothing here")[0]
    assert row["title"] == "" and row["errors"] == ["dateTime", "author", "content"]
    assert parse(spark, article(author=""), on_error="drop") == []
    assert parse(spark, article(ninth=""))[0]["errors"] == ["content"]


def test_page_that_was_not_fetched(spark):
    for profile in (extract.NEWS_SITE, extract.PLAIN_PAGES):
        pages = spark.createDataFrame([("u", None)], "url string, html string")
        row = extract.articles(pages, profile).first()
        assert row["errors"] == ["html"] and row["url"] == "u" and row["title"] is None
        assert extract.articles(pages, profile, on_error="drop").count() == 0


def test_pattern_and_tree_profiles_agree(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    native = extract.articles(pages, extract.PLAIN_PAGES)
    tree = extract.articles(pages, extract.PLAIN_PAGES_TREE)
    assert native.count() == 50 and native.exceptAll(tree).count() == 0


def test_awkward_markup_agrees(spark):
    bodies = [
        "<article><p>a<br>b <b>c<p>d</p>\n<p> e &amp;lt; f &#38;gt; &#x416;&#10;x</article>",
        "<ARTICLE class='x'>head<P id=1>one</P><p>two<!-- <p>no</p> --></article>",
        "<article>no paragraph</article>",
        "no article",
        "<title>t&copy;<b></title><article><p>1 < 2 &middot; 3</p></article>",
    ]
    pages = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "url string, html string")
    native = {r["url"]: r["content"] for r in extract.articles(pages).collect()}
    tree = {r["url"]: r["content"] for r in extract.articles(pages, extract.PLAIN_PAGES_TREE).collect()}
    assert native["0"] == tree["0"] == "a b cde &lt; f &gt; Ж x"
    assert native["1"] == tree["1"] == "onetwo"
    assert native["2"] == tree["2"] == ""
    assert native["3"] is None and tree["3"] is None
    assert native["4"] == tree["4"] == "1 < 2 · 3"


def test_unescape(spark):
    df = spark.createDataFrame([("a &amp;lt; &#38;lt; &#x41;&#1078; &#128512; &#0; &quot;",), (None,)], "t string")
    assert [r[0] for r in df.select(html.unescape(F.col("t"))).collect()] == ["a &lt; &lt; Aж 😀 � \"", None]


def test_references_without_semicolon(spark):
    df = spark.createDataFrame([("a&amp b &copy1 &ampamp; &ampcopy &hellip x&lt",)], "t string")
    row = df.select(html.unescape(F.col("t")).alias("text"), html.unescape(F.col("t"), attribute=True).alias("attr")).first()
    assert row["text"] == stdlib.unescape("a&amp b &copy1 &ampamp; &ampcopy x&lt").replace(" x", " &hellip x")
    assert row["attr"] == "a&amp b &copy1 &ampamp; &ampcopy &hellip x&lt"


def test_query_string_in_a_link_stays(spark):
    markup = '<li><a href="/p?a=1&copy=2&amp;b=3&lt=4">x</a></li>'
    pages = spark.createDataFrame([(1, "https://h.test/", markup)], "page_id long, url string, html string")
    assert extract.links(pages).first()["href"] == "/p?a=1&copy=2&b=3&lt=4"
    assert extract.cards(pages, extract.PLAIN_PAGES_TREE).first()["href"] == "/p?a=1&copy=2&b=3&lt=4"


def test_links_keep_or_resolve_absolute_targets(spark):
    pages = spark.createDataFrame(
        [(1, "https://h.test/p?q", '<a href="/x">1</a><A  HREF="https://o.test/y">2</a><a name="n">3</a>')],
        "page_id long, url string, html string",
    )
    assert [r["link"] for r in extract.links(pages).orderBy("pos").collect()] == [
        "https://h.test/x",
        "https://h.testhttps://o.test/y",
    ]
    assert extract.links(pages, resolve=True).orderBy(F.desc("pos")).first()["link"] == "https://o.test/y"


def test_card_that_the_page_breaks_off_in(spark):
    markup = LISTING + '<div class="card__inner"><h3>Cut</h3><a href="/n/4">'
    pages = spark.createDataFrame([("https://site.test", markup)], "url string, html string")
    rows = extract.cards(pages).orderBy("pos").collect()
    assert [(r["title"], r["link"], r["error"]) for r in rows[2:]] == [
        ("Three", "https://site.test", None),
        (None, None, "unclosed"),
    ]


AWKWARD = [
    "",
    "plain",
    "< 3 <3 a<b",
    "<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table><p>x<div>y</div>z",
    "<div class='a b'><p>1<p>2<div class=b>3</div></div><div class=\"b\">4 &amp;lt; <b>5</i></b></div>",
    "<div>x<script>if (a<b) '</div>'</script><p class='b'>y</p><!-- <div class=b> --></div><br><hr>",
    "<dl><dt>a<dd>b<dt class=b>c</dl><p>q</i>r</p><P CLASS='b'>T</P>",
    "<div title='a>b' class='x b'><i>1</i><img src=x class=b><i>2</i></div></div></p>",
    "<table><tr><td><p>a</table><div class=b>after<table><td>k</i>m</td></table></div>",
    "<div class=b><div class=b><div class=b>deep</div></div>",
]


@pytest.mark.parametrize("selector", ["div", ".b", "div.b", "li", "p", "td", "tr", "dt", "i"])
def test_elements_equal_the_tree(spark, selector):
    pages = spark.createDataFrame([(i, markup) for i, markup in enumerate(AWKWARD)], "i int, html string")
    found = F.transform(elements.select(F.col("html"), selector), elements.text).alias("found")
    inner = F.transform(elements.select(F.col("html"), selector), lambda e: F.size(elements.children(e))).alias("inner")
    for row in pages.select("i", found, inner).collect():
        want = dom.select([dom.parse_html(AWKWARD[row["i"]])], selector)
        assert row["found"] == [e.text() for e in want], AWKWARD[row["i"]]
        assert row["inner"] == [len(e.children) for e in want], AWKWARD[row["i"]]


@pytest.mark.parametrize("path", [("p",), ("ul", 1, 0, 0), ("ul", 7), ("q", 0), (".b", "div", 0), ("table", 0, 1)])
def test_paths_equal_the_tree(spark, path):
    pages = spark.createDataFrame([(i, markup) for i, markup in enumerate(AWKWARD)], "i int, html string")
    found = elements.locate(pages, {"t": path})
    for row in found.select("i", elements.text(F.col("t")).alias("t")).collect():
        want = dom.locate(dom.parse_html(AWKWARD[row["i"]]), path)
        assert row["t"] == (None if want is None else want.text())


def test_end_tag_that_closes_nothing(spark):
    pages = spark.createDataFrame([("<div>a</b>b</section>c</div>",)], "html string")
    assert pages.select(F.transform(elements.select(F.col("html"), "div"), elements.text)).first()[0] == ["ab c"]


def test_no_python_in_the_tree_profile(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    for frame in (extract.articles(pages, extract.NEWS_SITE), extract.cards(pages)):
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_article_lines(spark):
    records = spark.createDataFrame(
        [("t", "u", None, "d", "c", [])], extract.ARTICLE_SCHEMA
    )
    assert extract.article_lines(records).first()["line"] == "null, d \nt: u \nc"


def test_extraction_of_many_partitions_has_no_shuffle(spark, data, tmp_path):
    spark.read.parquet(f"{data}/pages.parquet").repartition(8).write.parquet(str(tmp_path / "pages"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128MB")
    try:
        many = spark.read.parquet(str(tmp_path / "pages"))
        assert many.rdd.getNumPartitions() == 8
        for profile in (extract.PLAIN_PAGES, extract.PLAIN_PAGES_TREE):
            assert "Exchange" not in extract.articles(many, profile)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_tree_helper():
    root = dom.parse_html("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table><p>x<div>y</div>z")
    assert [e.text() for e in dom.select([root], "li")] == ["a", "b c", "c"]
    assert [e.text() for e in dom.select([root], "td")] == ["1", "2", "3"]
    assert len(dom.select([root], "tr")) == 2
    assert dom.locate(root, ("p",)).text() == "x"
    assert dom.locate(root, ("ul", 1, 0, 0)).text() == "c"
    assert dom.locate(root, ("ul", 7)) is None and dom.locate(root, ("q", 0)) is None
