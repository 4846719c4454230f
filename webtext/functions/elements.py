"""Elements of a page by selector and child position, as native column expressions.

One fold over a page's tags keeps the names of the open elements; where an element begins and ends
is noted as it passes. No Python runs on executors, and a page costs time in proportion to its tags.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import html

# Fixed values from the HTML standard: elements without content, elements that close an open
# paragraph, elements that bound what an end tag or a sibling closes.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCK = (
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section "
    "summary table ul"
).split()
SCOPE = "html body table td th caption ul ol dl select button object".split()
TABLE = ["table", "td", "th"]
# Elements whose start closes open siblings; each group is closed in turn.
SIBLINGS = [
    (["li"], [["li"]]),
    (["dt", "dd"], [["dt", "dd"]]),
    (["option"], [["option"]]),
    (["tr"], [["td", "th"], ["tr"]]),
    (["td", "th"], [["td", "th"]]),
]

#: Tags around which words are apart.
SPACED = "|".join([*BLOCK, "br", "body", "html", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "title"])

_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: Pieces that make up the whole page: comments, scripts and styles with content, tags, text.
TOKEN = (
    r"(?is)<!--.*?-->|<(?:script|style)(?=[\s/>])[^>]*>.*?</(?:script|style)\s*>|<[!?][^>]*>"
    rf"|</?[a-z]{_INSIDE}>|<|[^<]+"
)
NAME = r"^</?([A-Za-z][^\s/>]*)"
CLASS = (
    r"""(?i)^<[a-z][^\s/>]*(?:[\s/]+|(?!class\s*=)[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*+"""
    r"""class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
)
HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)(?=[\s/>])[^>]*>.*?</\1\s*>"
SPACING_TAG = rf"(?i)</?(?:{SPACED})(?=[\s/>]){_INSIDE}>"

_FOUND = "array<struct<begin:int,end:int,depth:int,which:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(names: Iterable[str]) -> Column:
    """A constant array from one literal, which keeps the plan small."""
    return F.split(F.lit(" ".join(sorted(set(names)))), " ")


def _among(tag: Column, names: Iterable[str]) -> Column:
    return F.array_contains(_words(names), tag)


def _closed(stack: Column, tags: list[str], barrier: list[str]) -> Column:
    """Open elements once the innermost of ``tags`` is closed, unless one of ``barrier`` is open inside it."""

    def innermost(names):
        at = F.transform(stack, lambda name, i: F.when(F.array_contains(names, name), i))
        return F.coalesce(F.array_max(at), F.lit(-1))

    outside = [name for name in barrier if name not in tags]
    inner = F.lit(-1) if not outside else innermost(_words(outside))
    return let(innermost(_words(tags)), lambda k: F.when((k >= 0) & (inner < k), F.slice(stack, 1, k)).otherwise(stack))


def _closing(tags: list[str], barrier: list[str]) -> Callable[[Column], Column]:
    return lambda stack: _closed(stack, tags, barrier)


def _after_start(stack: Column, tag: Column) -> Column:
    """Open elements once the start tag has closed what it implies."""

    def siblings(open_now):
        chain = None
        for tags, groups in SIBLINGS:
            barrier = [name for name in SCOPE if not any(name in group for group in (*groups, tags))]
            kept = open_now
            for group in groups:
                kept = let(kept, _closing(group, barrier))
            chain = F.when(_among(tag, tags), kept) if chain is None else chain.when(_among(tag, tags), kept)
        return chain.otherwise(open_now)

    without_p = F.when(
        _among(tag, BLOCK), _closed(stack, ["p"], [name for name in SCOPE if name not in ("ul", "ol", "dl")])
    ).otherwise(stack)
    return let(without_p, siblings)


def _after_end(stack: Column, tag: Column) -> Column:
    """Open elements once the end tag has closed its element; one that closes nothing is passed over."""

    def cut(back):
        above = F.slice(stack, F.size(stack) - back + 2, back - 1)
        blocked = ~_among(tag, SCOPE) & F.arrays_overlap(above, _words(TABLE))
        return F.when((back == 0) | ((back > 1) & blocked), stack).otherwise(F.slice(stack, 1, F.size(stack) - back))

    return let(F.array_position(F.reverse(stack), tag).cast("int"), cut)


def _spans(markup: Column, hits: Sequence[Callable[[Column, Column], Column]], depth: int | None = None) -> Column:
    """Where elements begin and end, in page order: those that one of ``hits(tag name, start tag)``, at ``depth`` if given.

    ``which`` is the place of the test in ``hits``; all of them share one pass. ``end`` is before the end tag, and NULL
    where the page ends first.
    """
    none = F.array().cast("array<int>")
    opening = lambda token: token.rlike(r"^<[A-Za-z]")
    tokens = F.transform(
        F.regexp_extract_all(markup, F.lit(TOKEN), F.lit(0)),
        lambda token: let(
            F.lower(F.regexp_extract(token, NAME, 1)),
            lambda tag: F.struct(
                F.length(token).alias("n"),
                tag.alias("tag"),
                F.startswith(token, F.lit("</")).alias("closes"),
                (_among(tag, VOID) | (_among(tag, ["script", "style"]) & F.contains(token, F.lit("</")))).alias("void"),
                F.when(opening(token), F.array_compact(F.array(*[F.when(hit(tag, token), F.lit(i)) for i, hit in enumerate(hits)])))
                .otherwise(none)
                .alias("hits"),
            ),
        ),
    )
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<string>").alias("stack"), F.array().cast(_FOUND).alias("found")
    )

    def step(state, token):
        stack, at, tag = state["stack"], state["at"], token["tag"]
        opens = ~token["closes"]

        def after(kept):
            level = F.size(kept)
            past = at + token["n"]
            # An element is over when its place in the row of open ones is given up.
            ended = F.when(
                level < F.size(stack),
                F.transform(
                    state["found"],
                    lambda f: F.struct(
                        f["begin"].alias("begin"),
                        F.when(f["end"].isNull() & (f["depth"] >= level), at).otherwise(f["end"]).alias("end"),
                        f["depth"].alias("depth"),
                        f["which"].alias("which"),
                    ),
                ),
            ).otherwise(state["found"])
            new = F.transform(
                token["hits"],
                lambda i: F.struct(at.alias("begin"), F.when(token["void"], past).alias("end"), level.alias("depth"), i.alias("which")),
            )
            wanted = opens & (F.size(token["hits"]) > 0) & (F.lit(True) if depth is None else level == depth)
            return F.struct(
                past.alias("at"),
                F.when(opens & ~token["void"], F.array_append(kept, tag)).otherwise(kept).alias("stack"),
                F.when(wanted, F.concat(ended, new)).otherwise(ended).cast(_FOUND).alias("found"),
            )

        moved = let(F.when(opens, _after_start(stack, tag)).otherwise(_after_end(stack, tag)), after)
        passed = F.struct((at + token["n"]).alias("at"), stack.alias("stack"), state["found"].alias("found"))
        return F.when(tag == "", passed).otherwise(moved)

    return F.aggregate(tokens, empty, step)["found"]


def _matcher(selector: str) -> Callable[[Column, Column], Column]:
    """``tag``, ``.class`` or ``tag.class``."""
    tag, _, cls = selector.partition(".")

    def hit(name, token):
        tests = [name == tag] if tag else []
        if cls:
            value = F.concat(*[F.regexp_extract(token, CLASS, i) for i in (1, 2, 3)])
            tests.append(F.array_contains(F.split(value, r"[ \t\n\f\r]+"), cls))
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    return hit


def _cut(markup: Column, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.substr(markup, s["begin"] + 1, F.coalesce(s["end"], F.length(markup)) - s["begin"]),
    )


def select(markup: Column, selector: str) -> Column:
    """Elements that match, nested ones too, as an array of markup without the last end tag."""
    return _cut(markup, _spans(markup, [_matcher(selector)]))


def select_marked(markup: Column, selector: str) -> Column:
    """Like :func:`select`, as ``(markup, closed)``; ``closed`` is false where the page ends inside the element."""
    return F.transform(
        _spans(markup, [_matcher(selector)]),
        lambda s: F.struct(
            F.substr(markup, s["begin"] + 1, F.coalesce(s["end"], F.length(markup)) - s["begin"]).alias("markup"),
            s["end"].isNotNull().alias("closed"),
        ),
    )


def children(element: Column, selector: str | None = None) -> Column:
    """Child elements of an element's markup, in order; only those that match, if there is a selector."""
    hit = _matcher(selector) if selector else lambda name, token: F.lit(True)
    return _cut(element, _spans(element, [hit], 1))


def _selection(selector: str) -> Callable[[Column], Column]:
    return lambda element: select(element, selector)


def locate(pages: DataFrame, paths: Mapping[str, tuple], markup: str = "html") -> DataFrame:
    """Add a column for each path: markup of the first element on a path of selectors and child positions, or NULL.

    Selectors narrow the selection; the first number takes the first match, then each number takes
    that child. Each step is a projection of its own, all paths at once; their first selectors share one pass.
    """
    first = {name: path[0] for name, path in paths.items() if path and isinstance(path[0], str)}
    found = pages.withColumns({name: F.array(markup) for name in paths})
    if first:
        spans = _spans(F.col(markup), [_matcher(selector) for selector in first.values()])
        shared = found.withColumn("_spans", spans)
        own = lambda k: F.filter("_spans", lambda s: s["which"] == k)
        found = shared.withColumns({name: _cut(F.col(markup), own(k)) for k, name in enumerate(first)}).drop("_spans")
    for i in range(max(map(len, paths.values()), default=0)):
        steps = {}
        for name, path in paths.items():
            if i == 0 and name in first:
                continue
            if i < len(path) and isinstance(path[i], int):
                steps[name] = F.slice(children(F.get(F.col(name), F.lit(0))), path[i] + 1, 1)
            elif i < len(path):
                steps[name] = F.flatten(F.transform(F.col(name), _selection(path[i])))
        found = found.withColumns(steps)
    return found.withColumns({name: F.get(F.col(name), F.lit(0)) for name in paths})


def text(element: Column) -> Column:
    """Text of an element's markup, whitespace-normalised; block elements and breaks separate words.

    An end tag of a block that closes nothing separates words too.
    """
    shown = F.regexp_replace(F.regexp_replace(element, HIDDEN, ""), SPACING_TAG, " ")
    return let(F.regexp_replace(shown, html.MARKUP, ""), lambda bare: html.normalise_space(html.unescape(bare)))
