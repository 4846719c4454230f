"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each present or not: its words, pairs of neighbouring words, pairs with one
word between them, and the first letters of longer words, hashed into ``2**bits`` buckets. FTRL has
a learning rate per coordinate and an L1 term that leaves few weights, so the model is a small
table that is broadcast (``2**bits`` weights at most). It is fitted in one task on at most about
``rows_per_class`` labelled rows per class, picked by hash, and the intercept is corrected for the
picking. Every text is scored whole.

Defined results: null text is empty and has the intercept's score; a null key counts as the empty
text when rows are dealt to training; rows with a null label are not used; equal rows are scored
each; without any usable label all scores are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.rows import SLICE_BYTES, emptied, kept, slices, texts_of
from webtext.llm.words import WORD, Hashed, mix
from webtext.session import materialise

_PREFIX = 5


def features(texts: list[str], bits: int, known: tuple[Hashed, Hashed] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, bucket)`` of every feature occurrence; ``known`` holds the words and prefixes a task has met."""
    of_words, of_prefixes = known or (Hashed(), Hashed())
    words = [WORD.findall(text.lower()) for text in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = [word for text in words for word in text]
    doc = np.repeat(np.arange(len(texts)), counts)
    single = of_words.hash(flat)
    prefix = of_prefixes.hash([word[:_PREFIX] for word in flat])
    found = [(doc, single), (doc, mix(prefix ^ np.uint64(3)))]
    for gap, sign in ((1, 1), (2, 2)):
        same = doc[:-gap] == doc[gap:]
        pair = mix(single[:-gap] + np.uint64(sign)) ^ single[gap:]
        found.append((doc[:-gap][same], pair[same]))
    docs = np.concatenate([d for d, _ in found])
    hashes = mix(np.concatenate([h for _, h in found]))
    return docs, (hashes >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the fit."""

    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    epochs: int = 10
    rows_per_class: int = 8_000

    def fit(self, examples: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, float]:
        """Weights and intercept from examples that list their buckets."""
        z, n = np.zeros(1 << self.bits), np.zeros(1 << self.bits)
        bias_z = bias_n = 0.0

        def weights(z, n):
            return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

        def bias():
            return -bias_z / ((self.beta + math.sqrt(bias_n)) / self.alpha)

        for _ in range(self.epochs):
            for at, label in zip(examples, labels):
                z_at, n_at = z[at], n[at]
                w = weights(z_at, n_at)
                b = bias()
                g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w.sum()) + b)))) - label
                grown = n_at + g * g
                z[at] = z_at + g - (np.sqrt(grown) - np.sqrt(n_at)) / self.alpha * w
                n[at] = grown
                bias_z += g - (math.sqrt(bias_n + g * g) - math.sqrt(bias_n)) / self.alpha * b
                bias_n += g * g
        return weights(z, n), bias()


@dataclass(frozen=True)
class Model:
    """Buckets with a weight, in ascending order, their weights, and the intercept (None: nothing was learnt)."""

    bits: int
    buckets: np.ndarray
    weights: np.ndarray
    intercept: float | None

    def score(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """``(doc_id, score)``: the probability of label 1."""
        model = docs.sparkSession.sparkContext.broadcast(self)
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, known = model.value, (Hashed(), Hashed())
            dense = own.dense()
            for part in slices(batches, "text"):
                scores = own.of(texts_of(part), dense, known)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], schema=schema)

        chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        return chosen.mapInArrow(run, "doc_id bigint, score double")

    def below(self, docs: DataFrame, limit: float, text: str = "text") -> DataFrame:
        """The rows of ``docs`` whose score is below ``limit``."""
        model = docs.sparkSession.sparkContext.broadcast(self)

        def judge():
            own, known = model.value, (Hashed(), Hashed())
            dense = own.dense()
            return lambda texts: own.of(texts, dense, known) < limit

        return kept(docs, text, judge)

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << self.bits, np.float32)
        weights[self.buckets] = self.weights
        return weights

    def of(self, texts: list[str], dense: np.ndarray, known: tuple[Hashed, Hashed] | None = None) -> np.ndarray:
        if self.intercept is None:
            return np.zeros(len(texts))
        doc, bucket = features(texts, self.bits, known)
        hit = dense[bucket] != 0
        once = np.unique(doc[hit] * (1 << self.bits) + bucket[hit])
        total = np.bincount(once >> self.bits, dense[once & ((1 << self.bits) - 1)].astype(np.float64), len(texts)) + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def fit(docs: DataFrame, labelled: DataFrame, how: Ftrl = Ftrl(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learns from ``labelled (key, label)``: label 0 or 1."""
    spark = docs.sparkSession
    usable = labelled.filter(F.col(label).isin(0, 1)).select(F.col(key).cast("bigint").alias("_key"), F.col(label).cast("int").alias("_label"))
    counts = {row[0]: row[1] for row in usable.groupBy("_label").count().collect()}
    empty = Model(how.bits, np.zeros(0, np.int64), np.zeros(0), None)
    if not counts:
        return empty
    share = {c: min(1.0, how.rows_per_class / counts[c]) for c in counts}
    place = F.pmod(F.xxhash64(F.col("_key"), F.lit(17)), F.lit(1_000_003))
    limit = F.when(F.col("_label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)) * 1_000_003
    picked = F.broadcast(usable.filter(place < limit))  # about 2 * rows_per_class rows by construction
    bits = how.bits

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("place", pa.int64()), ("label", pa.int32()), ("buckets", pa.binary())])
        emptied()  # the worker may come from another operator
        known = Hashed(), Hashed()
        for part in slices(batches, "text", SLICE_BYTES // 2):
            doc, bucket = features(texts_of(part), bits, known)
            once = np.unique((doc << bits) + bucket)
            parts = np.split((once & ((1 << bits) - 1)).astype("<i4"), np.searchsorted(once >> bits, np.arange(1, part.num_rows)))
            rows = [p.tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([part.column("place"), part.column("label"), pa.array(rows, pa.binary())], schema=schema)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emptied()
        examples, labels = [], []
        for batch in batches:
            examples += [np.frombuffer(b, "<i4") for b in batch.column("buckets").to_pylist()]
            labels += batch.column("label").to_pylist()
        weights, bias = how.fit(examples, labels)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(weights[at], bias))], names=["bucket", "weight"]
        )

    chosen = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("text")).join(picked, "_key")
    chosen = chosen.select("text", F.xxhash64("_key", F.lit(29)).alias("place"), F.col("_label").alias("label"))
    extracted = materialise(chosen.mapInArrow(extract, "place bigint, label int, buckets binary"), "toxicity-features")
    one = extracted.repartition(1).sortWithinPartitions("place", "label", "buckets")
    rows = one.mapInArrow(train, "bucket int, weight double").collect()
    learnt = sorted((row[0], row[1]) for row in rows)
    if not learnt:
        return empty
    bias = learnt[0][1]
    if len(counts) == 2:
        bias += math.log(share[0] / share[1])
    return Model(bits, np.array([b for b, _ in learnt[1:]], np.int64), np.array([w for _, w in learnt[1:]]), bias)


def remainder(key: str, divisor: int):
    """crc32 of the key as text, modulo ``divisor``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % divisor
