"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

The score of a document sums, over the query's terms, integer impacts that are known for each (term, document). An index
segment holds the lists of some documents, each list sorted by falling impact. A search reads
the lists of its terms from the front only, all down to the same impact, which halves from round to round. For each document it keeps
the sum of what was read (the lower end of its score) and that sum plus the last read impact
of every list it was not met in (the upper end). Documents whose upper end is below the k-th largest
lower end, or below the k-th score of earlier segments of the task, are out. Reading goes on until the two ends meet for
every document that is left, so membership, ties and scores are final.

Spark counts the corpus statistics, cuts the documents into segments of bounded size, each inside a
task, and ranks the best k of all tasks. Queries come in blocks of bounded size; a block's terms are the
only thing sent to executors.

Defined results: null text has no terms; a document or query without terms is in no result; equal rows of
the documents are documents of their own, and equal scores rank by ascending key, a null key last; equal
rows of the queries are one query, and texts under one query key are ranked apart; an empty table gives no rows. Other columns of
the inputs are not read. A very long text is one document of its segment.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtext.llm.rows import slices
from webtext.session import materialise

#: Most queries of a block, and most characters of its texts, on average.
BLOCK_QUERIES, BLOCK_CHARS = 2_000, 4_000_000
#: A segment ends with the document that takes it to so many postings or documents.
SEGMENT_POSTINGS, SEGMENT_DOCS = 1_500_000, 40_000
SCALE = 1_000_000_000

# ASCII letters and digits and everything beyond ASCII make terms; only A-Z are lower-cased.
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_LAST = np.iinfo(np.int64).max


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order. No byte of a character beyond ASCII is an ASCII byte, so bytes can be split."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEPT).split()


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Corpus:
    """Number of documents with a term, all their terms, and the weight of each term of a block."""

    documents: int
    length: int
    weights: np.ndarray

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + (50 * n * self.documents) // max(self.length, 1)
        return self.weights[term] * ((SCALE * tf) // (1000 * tf + 20 * m))


class Segment:
    """Impact-sorted lists of some documents, numbered from 0 by ascending key."""

    def __init__(self, corpus: Corpus, keys: np.ndarray, n: np.ndarray, term: np.ndarray, tf: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(keys), np.int32)
        place[order] = np.arange(len(keys), dtype=np.int32)
        self.keys = keys[order]
        impact = corpus.impacts(term, tf, np.repeat(n, counts))
        held = np.flatnonzero(impact > 0)
        term, impact, doc = term[held], impact[held], np.repeat(place, counts)[held]
        by = np.lexsort((-impact, term))
        self.impact, self.doc = impact[by], doc[by]
        self.begins = np.searchsorted(term[by], np.arange(len(corpus.weights) + 1))

    def best(self, query: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents, best first, of those that may reach ``floor``."""
        lists = [(self.impact[b:e], self.doc[b:e]) for b, e in zip(self.begins[query], self.begins[query + 1]) if b < e]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = [0] * len(lists)
        last = np.array([impact[0] for impact, _ in lists], np.int64)
        lower = np.zeros(len(self.keys), np.int64)
        unseen = np.ones((len(lists), len(self.keys)), bool)
        alive = np.arange(len(self.keys))
        while True:
            level = int(last.max()) // 2
            for i, (impact, doc) in enumerate(lists):
                if last[i] <= level or at[i] == len(impact):
                    continue
                end = len(impact) - int(np.searchsorted(impact[::-1], level, side="right"))
                read = doc[at[i] : end]
                lower[read] += impact[at[i] : end]
                unseen[i, read] = False
                at[i] = end
                last[i] = impact[end] if end < len(impact) else 0
            own = lower[alive]
            upper = own.copy()
            for i in np.flatnonzero(last):
                upper += unseen[i, alive] * last[i]
            least = max(floor, 1, int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) > k else 1)
            left = upper >= least
            alive = alive[left]
            if (upper[left] == own[left]).all():
                break
        score = lower[alive]
        first = np.lexsort((alive, -score))[:k]
        return alive[first], score[first]


def _numbered(known: dict[bytes, int], text: str):
    """Postings of the terms of a block: ``(_key, n, term array<int>, tf array<int>)`` for every document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            words = [terms(value) for value in part.column(text).to_pylist()]
            n = np.fromiter(map(len, words), np.int64, len(words))
            found = np.fromiter((known.get(word, -1) for row in words for word in row), np.int64, int(n.sum()))
            row = np.repeat(np.arange(len(n)), n)[found >= 0]
            both, tf = np.unique(row * (len(known) + 1) + found[found >= 0], return_counts=True)
            row, term = np.divmod(both, len(known) + 1)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(n))))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32))) for values in (term, tf)]
            made = pa.RecordBatch.from_arrays([part.column("_key"), pa.array(n), *lists], names=["_key", "n", "term", "tf"])
            yield made.filter(pa.array(n > 0))

    return run


def _frequencies(size: int):
    """``(term, df)`` of a task's postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("term").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(df[held])], names=["term", "df"])

    return run


def _segments(corpus: Corpus, batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    held: list[tuple] = []
    postings = docs = 0

    def made() -> Segment:
        return Segment(corpus, *(np.concatenate(column) for column in zip(*held)))

    for batch in batches:
        lists = [batch.column(name) for name in ("term", "tf")]
        counts = np.diff(lists[0].offsets.to_numpy())
        ends = np.cumsum(counts)
        keys = batch.column("_key").fill_null(_LAST).to_numpy()
        n = batch.column("n").to_numpy()
        term, tf = (values.flatten().to_numpy().astype(np.int64) for values in lists)
        begin = 0
        while begin < len(counts):
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, min(int(np.searchsorted(ends, before + SEGMENT_POSTINGS - postings)) + 1, begin + SEGMENT_DOCS - docs, len(counts)))
            upto = int(ends[end - 1])
            held.append((keys[begin:end], n[begin:end], term[before:upto], tf[before:upto], counts[begin:end]))
            postings, docs, begin = postings + upto - before, docs + end - begin, end
            if postings >= SEGMENT_POSTINGS or docs >= SEGMENT_DOCS:
                yield made()
                held, postings, docs = [], 0, 0
    if held:
        yield made()


def _searched(corpus: Corpus, queries: list[np.ndarray], k: int):
    """The best ``k`` documents of a task for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for segment in _segments(corpus, batches):
            for q, query in enumerate(queries):
                keys, scores = best[q]
                places, more = segment.best(query, k, int(scores[-1]) if len(scores) == k else 0)
                if not len(places):
                    continue
                keys, scores = np.concatenate((keys, segment.keys[places])), np.concatenate((scores, more))
                first = np.lexsort((keys, -scores))[:k]
                best[q] = keys[first], scores[first]
        counts = [len(keys) for keys, _ in best]
        keys = np.concatenate([keys for keys, _ in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), counts).astype(np.int32)),
                pa.array(keys, mask=keys == _LAST),
                pa.array(np.concatenate([scores for _, scores in best])),
            ],
            names=["_query", "_key", "score"],
        )

    return run


def _blocks(queries: DataFrame) -> Iterator[list]:
    """The distinct rows of ``queries (_item, text)`` in blocks of bounded size, dealt by hash."""
    queries = materialise(queries.filter("text IS NOT NULL").distinct(), "queries")
    n, chars = queries.agg(F.count("*"), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_QUERIES), -(-chars // BLOCK_CHARS))
    for block in range(blocks):
        yield queries.filter(F.pmod(F.xxhash64("_item", "text"), F.lit(blocks)) == block).orderBy("_item", "text").collect()


def _of_block(spark: SparkSession, docs: DataFrame, rows: list, k: int) -> DataFrame:
    known: dict[bytes, int] = {}
    queries = [np.array(sorted({known.setdefault(word, len(known)) for word in terms(row["text"])}), np.int64) for row in rows]
    numbered = _numbered(known, "text")
    postings = materialise(docs.mapInArrow(numbered, "_key bigint, n bigint, term array<int>, tf array<int>"), "postings")
    documents, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = postings.select("term").mapInArrow(_frequencies(len(known)), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = dict(counted.collect())  # at most one row per term of the block
    corpus = Corpus(documents, length, np.array([weight(df.get(term, 0), documents) for term in range(len(known))], np.int64))
    found = postings.mapInArrow(_searched(corpus, queries, k), "_query int, _key bigint, score bigint")
    best = Window.partitionBy("_query").orderBy(F.desc("score"), F.asc_nulls_last("_key"))
    ranked = materialise(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "ranked")
    names = spark.createDataFrame([(q, row["_item"]) for q, row in enumerate(rows)], "_query int, _item bigint")
    return ranked.join(F.broadcast(names), "_query").select("_item", "rank", "_key", "score")


def search(
    queries: DataFrame, docs: DataFrame, k: int, item: str = "item_id", key: str = "doc_id", query_text: str = "text", text: str = "text"
) -> DataFrame:
    """``(item, rank, key, score)``: the ``k`` best rows of ``docs`` with a score above 0 for each row of ``queries``."""
    spark = docs.sparkSession
    chosen = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("text"))
    asked = queries.select(F.col(item).cast("bigint").alias("_item"), F.col(query_text).alias("text"))
    result = spark.createDataFrame([], "_item bigint, rank int, _key bigint, score bigint")
    for rows in _blocks(asked):
        if any(terms(row["text"]) for row in rows):
            result = result.union(_of_block(spark, chosen, rows, k))
    return result.select(F.col("_item").alias(item), "rank", F.col("_key").alias(key), "score")
