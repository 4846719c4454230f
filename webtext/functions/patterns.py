"""Regular expressions shared by the column functions.

Fixed values: results depend on these exact character sets.
"""

# Unicode whitespace, for use inside [...].
WS = r"\s\x0b\x1c-\x1f\x85\p{Z}"

# The 32 ASCII punctuation characters, for use inside [...].
PUNCT = r"!-/:-@\[-`{-~"

TAG_ON_LINE = r"<[^\n>]*>"
REFERENCE_MARK = r"\[[0-9]*\]"
NOT_WORD = rf"[^\p{{L}}\p{{N}}_{WS}]"
DIGIT = r"\p{Nd}"

# A search token, a feature term and a whitespace word.
SEARCH_TOKEN = r"[\p{L}\p{N}]+"
FEATURE_TERM = r"[\p{L}\p{N}_]{2,}"
WORD = rf"[^{WS}]+"

# Runs that are not yet one single space: same result as collapsing every run, but the many single
# spaces of running text are left alone.
HTML_RUN = r" [ \t\n\f\r]+|[\t\n\f\r][ \t\n\f\r]*"

# Characters other than letters, numbers, punctuation and whitespace.
OTHER_RUN = rf"[^\p{{L}} \p{{N}}{PUNCT}{WS}]+"
# Runs without a letter or a non-decimal number.
GAP_RUN = r" [^\p{L}\p{Nl}\p{No}]+|[^\p{L} \p{Nl}\p{No}][^\p{L}\p{Nl}\p{No}]*"

# The characters of WS and PUNCT one by one, for the trim function.
EDGE = "".join(
    chr(point)
    for first, last in (
        (0x09, 0x0D),
        (0x1C, 0x2F),
        (0x3A, 0x40),
        (0x5B, 0x60),
        (0x7B, 0x7E),
        (0x85, 0x85),
        (0xA0, 0xA0),
        (0x1680, 0x1680),
        (0x2000, 0x200A),
        (0x2028, 0x2029),
        (0x202F, 0x202F),
        (0x205F, 0x205F),
        (0x3000, 0x3000),
    )
    for point in range(first, last + 1)
)
