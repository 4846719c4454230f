"""HTML extraction as native column expressions: the fast path for pages of a known layout."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions.patterns import HTML_RUN

# Named character references the native path decodes, apart from ``&amp;``.
NAMED_REFERENCES = {
    "quot": '"',
    "lt": "<",
    "gt": ">",
    "nbsp": "\N{NO-BREAK SPACE}",
    "copy": "©",
    "reg": "®",
    "middot": "·",
    "laquo": "«",
    "raquo": "»",
    "apos": "'",
    "ndash": "–",
    "mdash": "—",
    "hellip": "…",
}

# Those of them that also count without their semicolon.
BARE_REFERENCES = ("quot", "lt", "gt", "nbsp", "copy", "reg", "middot", "laquo", "raquo")

TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
ARTICLE = r"(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>"
PARAGRAPH_START = r"(?i)<p(?:\s[^>]*)?>"
LINE_BREAK = r"(?i)<br\s*/?>"
MARKUP = r"(?s)<!--.*?-->|</?[A-Za-z][^>\x00]*>"

# HTML text holds no NUL, so it can stand for a paragraph start.
PARAGRAPH_MARK = "\0"

# The attributes of each start tag of ``a``; quoted values may hold ``>``.
ANCHOR = r"""(?i)<a(?=[\s/>])((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
# The value of the first ``href`` among them, in double, single or no quotes.
HREF = r"""(?i)^(?:[\s/]+|(?!href\s*=)[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
ORIGIN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"
NUMERIC_REFERENCE = r"&#(?:[0-9]+|[xX][0-9A-Fa-f]+);"
NAME_REFERENCE = r"&[A-Za-z][A-Za-z0-9]*;"
# All other names with a semicolon, from the standard library's copy of the HTML table.
OTHER_REFERENCES = {
    f"&{name}": text
    for name, text in html5.items()
    if name.endswith(";") and name[:-1] not in NAMED_REFERENCES and text != "&"
}


def _numeric_reference(reference: Column) -> Column:
    hexadecimal = F.lower(F.substring(reference, 3, 1)) == "x"
    digits = F.regexp_replace(reference, r"^&#[xX]?0*|;$", "")
    # Longer numbers lie beyond the last code point.
    short = F.when(F.length(digits) > 7, "9999999").when(digits == "", "0").otherwise(digits)
    point = F.when(hexadecimal, F.conv(short, 16, 10)).otherwise(short).cast("long")
    character = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    unusable = (point == 0) | (point > 0x10FFFF) | point.between(0xD800, 0xDFFF)
    # An ampersand stays escaped here, so that what follows it is not decoded a second time.
    return (
        F.when(point == 38, F.lit("&amp;"))
        .when(point.isin(9, 10, 12, 13), F.lit(" "))
        .when(unusable, F.lit("�"))
        .otherwise(character)
    )


def unescape(text: Column, attribute: bool = False) -> Column:
    """Decode character references, ``&amp;`` last.

    In text some names count without their semicolon; in an attribute they may be part of a query
    string (``?a&copy=1``) and stay. ``text`` is used more than once: pass a plain column, not a
    long expression.
    """
    decoded = F.when(
        F.contains(text, F.lit("&#")),
        F.aggregate(
            F.array_distinct(F.regexp_extract_all(text, F.lit(NUMERIC_REFERENCE), F.lit(0))),
            text,
            lambda acc, reference: F.replace(acc, reference, _numeric_reference(reference)),
        ),
    ).otherwise(text)
    if OTHER_REFERENCES:
        names = F.from_json(F.lit(json.dumps(OTHER_REFERENCES)), "map<string,string>")
        decoded = F.when(
            F.contains(text, F.lit(";")),
            F.aggregate(
                F.array_distinct(F.regexp_extract_all(text, F.lit(NAME_REFERENCE), F.lit(0))),
                decoded,
                lambda acc, reference: F.replace(acc, reference, F.coalesce(F.try_element_at(names, reference), reference)),
            ),
        ).otherwise(decoded)
    for name, character in NAMED_REFERENCES.items():
        decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(character))
        if name in BARE_REFERENCES and not attribute:
            decoded = F.replace(decoded, F.lit(f"&{name}"), F.lit(character))
    decoded = F.replace(decoded, F.lit("&AMP;"), F.lit("&amp;"))
    decoded = F.regexp_replace(decoded, "&amp;" if attribute else "&amp;?", "&")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def normalise_space(text: Column) -> Column:
    """Runs of HTML whitespace become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, HTML_RUN, " "))


def strip_markup(markup: Column) -> Column:
    """Drop tags and comments; a line break leaves a space. References stay escaped."""
    return F.regexp_replace(F.regexp_replace(markup, LINE_BREAK, " "), MARKUP, "")


def title_markup(markup: Column) -> Column:
    """Content of the title element, ``''`` if the page has none."""
    return F.regexp_extract(markup, TITLE, 1)


def first_group(markup: Column, pattern: str) -> Column:
    """First capture, or NULL when the pattern is not there."""
    return F.get(F.regexp_extract_all(markup, F.lit(pattern), F.lit(1)), F.lit(0))


def mark_paragraphs(body: Column) -> Column:
    """Put a mark in place of each paragraph start.

    Marking starts rather than matching ``<p>...</p>`` keeps paragraphs whose end tag is missing.
    """
    return F.regexp_replace(body, PARAGRAPH_START, PARAGRAPH_MARK)


def after_first_mark(marked: Column) -> Column:
    """What follows the first paragraph start; nothing if there is none."""
    position = F.locate(PARAGRAPH_MARK, marked)
    return F.when(position > 0, F.substr(marked, position + 1)).when(marked.isNotNull(), F.lit(""))


def join_paragraphs(marked_text: Column) -> Column:
    """Trim each paragraph and join them with no separator."""
    spaced = F.regexp_replace(marked_text, HTML_RUN, " ")
    return F.trim(F.regexp_replace(spaced, f" ?{PARAGRAPH_MARK} ?", ""))


def hrefs(markup: Column) -> Column:
    """Targets of anchors in page order; an anchor without ``href`` has none."""
    tags = F.filter(F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(1)), lambda tag: tag.rlike(HREF))
    targets = F.transform(tags, lambda tag: F.concat(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)]))
    return F.transform(targets, lambda href: unescape(href, attribute=True))


def origin(url: Column) -> Column:
    """Scheme and host of a URL."""
    return F.regexp_extract(url, ORIGIN, 0)


def absolute(site: Column, href: Column, resolve: bool = False) -> Column:
    """``site + href``; with ``resolve`` an already absolute target stays as it is."""
    joined = F.concat(site, F.coalesce(href, F.lit("")))
    return F.when(href.rlike(ORIGIN), href).otherwise(joined) if resolve else joined
