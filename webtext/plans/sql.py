"""SQL fragments the equivalent queries share (DuckDB dialect)."""

from __future__ import annotations

from webtext.functions.html import BARE_REFERENCES, NAMED_REFERENCES

WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def unescape(x: str, attribute: bool = False) -> str:
    """Named references only: the test pages hold no numeric ones."""
    for name, character in [*NAMED_REFERENCES.items(), ("amp", "&")]:
        bare = "?" if not attribute and name in (*BARE_REFERENCES, "amp") else ""
        x = f"regexp_replace({x}, '&{name};{bare}', {quote(character)}, 'g')"
    return x


def one_space(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[ \t\n\f\r]+', ' ', 'g'))"


def clean(x: str) -> list[str]:
    """The cleaning steps one after the other, all as nested expressions of ``x``."""
    strip = rf"regexp_replace(regexp_replace(%s, '^[{WS}]+', ''), '[{WS}]+$', '')"
    steps = [
        "lower(%s)",
        strip,
        r"regexp_replace(%s, '<[^\n]*?>', '', 'g')",
        r"regexp_replace(%s, '[!-/:-@\[-`\{-~]', ' ', 'g')",
        f"regexp_replace(%s, '[{WS}]+', ' ', 'g')",
        rf"regexp_replace({strip % 'lower(%s)'}, '[^\p{{L}}\p{{N}}_{WS}]', '', 'g')",
        r"regexp_replace(%s, '\p{Nd}', ' ', 'g')",
        f"regexp_replace(%s, '[{WS}]+', ' ', 'g')",
    ]
    results = []
    for step in steps:
        x = step.replace("%s", x)
        results.append(x)
    return results


def clean_text(x: str) -> str:
    return clean(x)[-1]


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{WS}]+')"


def terms(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def search_tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


HALF = """
half AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) <= (count(*) OVER () + 1) // 2 AS first_half FROM documents
)"""

SPLIT = f"""{HALF},
hashed AS (
  SELECT doc_id, text, ('0x' || substr(md5('42:' || doc_id), 1, 13))::bigint AS h FROM half WHERE first_half
),
split AS (
  SELECT doc_id, {clean_text('text')} AS clean_text,
    row_number() OVER (ORDER BY h, doc_id) <= ceil(0.2 * count(*) OVER ()) AS in_test
  FROM hashed
)"""
