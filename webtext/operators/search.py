"""Match-all, full-text and exact-term search with totals, scores and top hits.

A query has few terms, so each document counts them in its own row: no token rows, no shuffle of
text. Corpus statistics (documents, mean length, document frequencies) are one partially
aggregated row that the score reads as scalar subqueries.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.functions.patterns import SEARCH_TOKEN
from webtext.sources.collections import source_json

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def tokens(text: Column) -> Column:
    """Analysed text: lower-case runs of letters and numbers."""
    return F.regexp_extract_all(F.lower(text), F.lit(SEARCH_TOKEN), F.lit(0))


def analyse(spark: SparkSession, text: str) -> Counter:
    """Query tokens with their number of occurrences, by the same rule as the documents."""
    row = spark.range(1).select(tokens(F.lit(text)).alias("t")).first()
    return Counter(row["t"])


@dataclass(frozen=True)
class Hits:
    """Matching documents with ``_score``; nothing runs until a part is asked for."""

    matched: DataFrame
    key: str

    def total(self) -> DataFrame:
        """Exact number of matches, one row."""
        return self.matched.agg(F.count("*").alias("total"))

    def top(self, size: int = 10) -> DataFrame:
        """Best hits, ties by key."""
        return self.matched.orderBy(F.desc("_score"), F.asc(self.key)).limit(size)

    def sources(self, size: int = 10) -> DataFrame:
        """Best hits as JSON text with their score."""
        columns = [name for name in self.matched.columns if name != "_score"]
        return self.top(size).select(self.key, source_json(*columns).alias("_source"), "_score")


def match_all(documents: DataFrame, key: str) -> Hits:
    return Hits(documents.withColumn("_score", F.lit(1.0)), key)


def _none(documents: DataFrame, key: str) -> Hits:
    return Hits(documents.filter(F.lit(False)).withColumn("_score", F.lit(0.0)), key)


def _held(df: DataFrame, value: Column) -> DataFrame:
    """Add a column through a one-element generator.

    A filter on the column stays behind the generator. With a plain projection the optimizer would
    move the expression into the filter and compute it once per use.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(value))))


def _ranked(documents: DataFrame, column: str, key: str, terms: Counter) -> Hits:
    if not terms:
        return _none(documents, key)
    names = sorted(terms)

    def token_counts(lowered, kept):
        tokenized = lowered.withColumn("_tokens", F.regexp_extract_all("_lowered", F.lit(SEARCH_TOKEN), F.lit(0)))
        return tokenized.select(
            *kept,
            F.size("_tokens").alias("_length"),
            # A term occurs as often as its removal shortens the token array.
            *[
                (F.size("_tokens") - F.size(F.array_remove("_tokens", F.lit(term)))).alias(f"_tf{i}")
                for i, term in enumerate(names)
            ],
        )

    texts = documents.select(column).filter(F.col(column).isNotNull())
    corpus = (
        token_counts(texts.select(F.lower(column).alias("_lowered")), [])
        .agg(
            F.count("*").alias("n"),
            F.avg("_length").alias("mean_length"),
            *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(names))],
        )
        .select(F.struct("*").alias("corpus"))
        .scalar()
    )
    # Substring tests spare most documents the pattern, the pattern spares the rest the tokenizer.
    substring = reduce(lambda a, b: a | b, [F.contains("_lowered", F.lit(term)) for term in names])
    whole_token = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(names)})(?![\p{{L}}\p{{N}}])"
    lowered = _held(documents, F.lower(column).alias("_lowered"))
    hits = lowered.filter(substring & F.col("_lowered").rlike(whole_token))
    matched = token_counts(hits, documents.columns)
    length_part = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("_length") / corpus["mean_length"])
    score = F.lit(0.0)
    for i, term in enumerate(names):
        df = corpus[f"df{i}"]
        tf = F.col(f"_tf{i}").cast("double")
        idf = F.ln(1 + (corpus["n"] - df + 0.5) / (df + 0.5))
        score = score + F.lit(float(terms[term])) * idf * tf / (tf + length_part)
    return Hits(matched.select(*documents.columns, score.alias("_score")), key)


def match(documents: DataFrame, column: str, text: str, key: str) -> Hits:
    """Documents with at least one token of ``text``, ranked by BM25.

    A token given twice counts twice, as two clauses would.
    """
    return _ranked(documents, column, key, analyse(documents.sparkSession, text))


def term(documents: DataFrame, column: str, value: str, key: str, analysed: bool = True) -> Hits:
    """Documents that hold exactly the token ``value``, which is itself not analysed.

    ``analysed=False`` is for keyword columns: the whole value is compared (the filter reaches the
    scan) and every hit scores 1.
    """
    if not analysed:
        return Hits(documents.filter(F.col(column) == value).withColumn("_score", F.lit(1.0)), key)
    if list(analyse(documents.sparkSession, value)) != [value]:
        return _none(documents, key)  # not a token, so no document holds it
    return _ranked(documents, column, key, Counter([value]))
