"""Text cleaning as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import stopwords
from webtext.functions.patterns import (
    DIGIT,
    EDGE,
    GAP_RUN,
    NOT_WORD,
    OTHER_RUN,
    PUNCT,
    REFERENCE_MARK,
    TAG_ON_LINE,
    WORD,
    WS,
)


def trim_whitespace(text: Column) -> Column:
    """Drop Unicode whitespace at both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(F.regexp_replace(text, f"^[{WS}]+", ""), f"[{WS}]+$", "")


def strip_tags(text: Column) -> Column:
    """Drop ``<...>``; a tag does not go over a line end."""
    return F.regexp_replace(text, TAG_ON_LINE, "")


def punctuation_to_space(text: Column) -> Column:
    return F.regexp_replace(text, f"[{PUNCT}]", " ")


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WS}]+", " ")


def strip_reference_marks(text: Column) -> Column:
    """``[12]`` becomes a space. Not part of :func:`preprocess`: there the brackets are gone."""
    return F.regexp_replace(text, REFERENCE_MARK, " ")


def keep_word_characters(text: Column) -> Column:
    """Lower-case, trim, then delete all but letters, numbers, ``_`` and whitespace."""
    return F.regexp_replace(trim_whitespace(F.lower(text)), NOT_WORD, "")


def digits_to_space(text: Column) -> Column:
    return F.regexp_replace(text, DIGIT, " ")


STEPS: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("lower", F.lower),
    ("trimmed", trim_whitespace),
    ("untagged", strip_tags),
    ("unpunctuated", punctuation_to_space),
    ("single_spaced", collapse_whitespace),
    ("word_characters", keep_word_characters),
    ("undigited", digits_to_space),
    ("cleaned", collapse_whitespace),
)


def cleaning_steps(text: Column) -> list[Column]:
    """The text after each step, for a look at what each one does."""
    columns = []
    for name, step in STEPS:
        text = step(text)
        columns.append(text.alias(name))
    return columns


def preprocess(text: Column) -> Column:
    """All of :data:`STEPS` at once; an edge space may stay.

    The steps fold to fewer passes with the same result. Punctuation and whitespace at the ends
    are trimmed before other symbols are deleted, so ``« x`` keeps its space. Inside, a run of
    punctuation, whitespace and digits ends up as one space.
    """
    text = F.btrim(strip_tags(F.lower(text)), F.lit(EDGE))
    return F.regexp_replace(F.regexp_replace(text, OTHER_RUN, ""), GAP_RUN, " ")


def words(text: Column) -> Column:
    """Split on whitespace runs, without empty strings."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def clean_words(clean_text: Column) -> Column:
    """:func:`words` of text that holds no whitespace but single spaces."""
    return F.array_remove(F.split(clean_text, " "), "")


def each_token(df: DataFrame, tokens: str, *carried: str, name: str = "token") -> DataFrame:
    """One row per token: ``(*carried, name)``.

    The outer form with a filter behind it, because for the plain form the optimizer puts a test
    for empty arrays in front, which computes the tokens a second time.
    """
    return df.select(*carried, F.explode_outer(tokens).alias(name)).filter(F.col(name).isNotNull())


def join_words(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def stop_words(language: str = "russian") -> list[str]:
    """The stop list of a language (about 150 words); plain data, the same for every reader."""
    return stopwords.words(language)


def drop_stop_words(tokens: Column, stop: Iterable[str]) -> Column:
    """Keep the tokens that are not on the list; the match is exact."""
    stop = list(stop)
    return F.filter(tokens, lambda token: ~token.isin(stop)) if stop else tokens


def remove_stop_words(text: Column, stop: Iterable[str]) -> Column:
    return join_words(drop_stop_words(words(text), stop))


# First letter of a part-of-speech tag -> word class.
# П adjective, Г verb, С noun, Р adverb; any other tag counts as noun.
WORD_CLASSES = {"П": "a", "Г": "v", "С": "n", "Р": "r"}


def word_class(tag: Column) -> Column:
    """``a``, ``v``, ``n`` or ``r`` from a tag; an unknown or missing tag is a noun."""
    first = F.substring(tag, 1, 1)
    classes = F.create_map(*[F.lit(x) for pair in WORD_CLASSES.items() for x in pair])
    return F.coalesce(F.try_element_at(classes, F.coalesce(first, F.lit(""))), F.lit("n"))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; NULL stays NULL."""
    return F.array_size(words(text))


def char_count(text: Column) -> Column:
    """Number of code points; NULL stays NULL."""
    return F.length(text)
