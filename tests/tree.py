"""A small element tree over the standard library's tokenizer: what the native elements are compared with."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

# Fixed values from the HTML standard: elements without content, elements that
# close an open paragraph, and elements that close an open sibling of their kind.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section "
    "summary table ul".split()
)
SPACED = BLOCK | {"br", "body", "html", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "title"}
SIBLING_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
SCOPE = frozenset("html body table td th caption ul ol dl select button object".split())
HIDDEN = frozenset({"script", "style", "template"})
HTML_SPACE = re.compile(r"[ \t\n\f\r]+")


class Element:
    __slots__ = ("tag", "attrs", "nodes")

    def __init__(self, tag, attrs=()):
        self.tag = tag
        self.attrs = dict(reversed(attrs))
        self.nodes = []

    @property
    def children(self):
        return [node for node in self.nodes if isinstance(node, Element)]

    def matches(self, selector):
        """``tag``, ``.class`` or ``tag.class``."""
        tag, _, cls = selector.partition(".")
        if tag and self.tag != tag:
            return False
        return not cls or cls in (self.attrs.get("class") or "").split()

    def walk(self):
        """This element and all below it, in document order."""
        stack = [self]
        while stack:
            element = stack.pop()
            yield element
            stack.extend(reversed(element.children))

    def text(self):
        """Text below, whitespace-normalised; block elements and breaks separate words."""
        parts = []
        stack = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in HIDDEN:
                spaced = node.tag in SPACED
                if spaced:
                    parts.append(" ")
                    stack.append(" ")
                stack.extend(reversed(node.nodes))
        return HTML_SPACE.sub(" ", "".join(parts)).strip(" ")


def _attribute(raw, name, value):
    """Value of an attribute, decoding only references with a semicolon.

    Some versions of the tokenizer take ``&copy`` in ``?a&copy=1`` for a sign.
    """
    found = re.search(rf"""(?i)[\s"'/]{re.escape(name)}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", raw)
    if found is None:
        return value
    written = next(group for group in found.groups() if group is not None)
    return re.sub(r"&#?\w+;", lambda reference: unescape(reference[0]), written)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root")
        self.open = [self.root]

    def _close(self, tags, barrier):
        for position in range(len(self.open) - 1, 0, -1):
            tag = self.open[position].tag
            if tag in tags:
                del self.open[position:]
                return
            if tag in barrier:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._close({"p"}, SCOPE - {"ul", "ol", "dl"})
        if tag in SIBLING_CLOSES:
            # A row closes its open cell first, then the row before it.
            for closing in (SIBLING_CLOSES[tag] - {tag}, {tag}):
                self._close(closing, SCOPE - SIBLING_CLOSES[tag])
        raw = self.get_starttag_text() or ""
        if "&" in raw:
            attrs = [(name, _attribute(raw, name, value)) for name, value in attrs]
        element = Element(tag, attrs)
        self.open[-1].nodes.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        # A slash closes void elements only; elsewhere HTML ignores it.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close({tag}, () if tag in SCOPE else {"td", "th", "table"} - {tag})

    def handle_data(self, data):
        self.open[-1].nodes.append(data)


def parse_html(markup):
    builder = _TreeBuilder()
    builder.feed(markup)
    builder.close()
    return builder.root


def select(elements, selector):
    """Distinct matches in or below any of ``elements``, in document order."""
    seen = set()
    found = []
    for element in elements:
        for candidate in element.walk():
            if id(candidate) not in seen and candidate.matches(selector):
                seen.add(id(candidate))
                found.append(candidate)
    return found


def locate(root, path):
    """First element on a path of selectors and child positions, or None.

    Text entries narrow the selection; the first number takes the first match, then each number
    takes that child.
    """
    elements = [root]
    for step in path:
        if isinstance(step, int):
            children = elements[0].children if elements else []
            elements = children[step : step + 1]
        else:
            elements = select(elements, step)
    return elements[0] if elements else None
