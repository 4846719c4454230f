"""Keys, markup and lines of every form, not only those of the test data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from webtext.functions import html
from webtext.operators import extract, logs, splits


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 50])
@pytest.mark.parametrize("kind", ["hash", "text", "long text"])
def test_splits_of_any_key(spark, n, kind):
    ids = spark.range(n)
    key = {"hash": F.xxhash64("id"), "text": F.concat(F.lit("k"), F.col("id")), "long text": F.md5(F.col("id").cast("string"))}[kind]
    df = ids.select(key.alias("key"))
    keys = sorted(r["key"] for r in df.collect())
    first, second = splits.half_split(df, "key")
    assert sorted(r["key"] for r in first.collect()) == keys[: (n + 1) // 2]
    assert sorted(r["key"] for r in second.collect()) == keys[(n + 1) // 2 :]
    train, test = splits.train_test_split(df, "key")
    assert test.count() == -(-n // 5) and train.count() == n - -(-n // 5)


def test_half_split_over_all_64_bits(spark):
    ends = [-(2**63), 2**63 - 1, -(2**63) + 1, 0, 5, 2**63 - 2, -7]
    df = spark.createDataFrame([(v,) for v in ends], "key bigint")
    first, _ = splits.half_split(df, "key")
    assert sorted(r["key"] for r in first.collect()) == sorted(ends)[:4]


def test_anchors_of_every_form(spark):
    page = (
        "<a href=\"/1\">x</a><a class=\"b\" href='/2'>x</a><a href=/3>x</a><a target=_blank rel=x href = \"/4?a&amp;b\" >x</a>"
        "<a title=\"href=no > y\" data-href='/no' href='/5'>x</a><a>none</a><abbr href='/no'>x</abbr><A HREF=''>x</A><a\nhref=/6/>x</a>"
    )
    got = spark.createDataFrame([(page,)], "html string").select(html.hrefs(F.col("html"))).first()[0]
    assert got == ["/1", "/2", "/3", "/4?a&b", "/5", "", "/6/"]
    pages = spark.createDataFrame([(1, "https://s.test/x", page)], "page_id int, url string, html string")
    assert extract.links(pages).count() == 7


def test_all_character_references(spark):
    cases = {
        "Caf&eacute; &euro;5 &#x00000041;": "Café €5 A",
        "&alpha;&NotEqualTilde;&unknown; &#00000000065;": "α≂̸&unknown; A",
        "&#99999999999999999999; &#x110000; &#0;": "� � �",
        "&amp;eacute; &AMP; &lt;b&gt;": "&eacute; & <b>",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", html.unescape(F.col("t"))).collect()}
    assert got == cases


def test_only_fields_asked_for_can_be_missing(spark):
    page = "<html><title>T</title><article><p>one<p>two</article></html>"
    pages = spark.createDataFrame([("u", page), ("v", "<title>x</title>"), ("w", None)], "url string, html string")
    rows = {r["url"]: r for r in extract.articles(pages).collect()}
    assert rows["u"]["errors"] == [] and rows["v"]["errors"] == ["content"] and rows["w"]["errors"] == ["html"]
    assert [r["url"] for r in extract.articles(pages, on_error="drop").collect()] == ["u"]


def test_a_long_line_number_costs_one_field(spark):
    line = "2013-04-03 07:37:51.993 | WARN  | main       | lnetgateway.Server:12345678901    | My app"
    row = logs.parse_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert row["line"] is None and row["level"] == "WARN" and row["msg"] == "My app"
