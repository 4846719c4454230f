"""A written inverted index: a search reads the postings of its tokens and not the corpus.

An index is a folder of three tables. ``postings`` holds blocks of up to 128 postings of one token, in
folders by segment and by a hash of the token: first document number, differences to it, occurrences, document
lengths, and the largest number of occurrences and the smallest length of the block, which bound every score in it.
``docs`` maps document numbers to keys. ``segments`` has one row per finished segment and is written last, so
a build that broke off leaves nothing that a search sees. Appending writes a segment; merging writes one
that takes the place of several, without reading a text again.

Numbers are given per segment without a shuffle or a sort. A token in more documents than a range holds
is grouped by (token, range of numbers), any other by token, so a group never exceeds a
range and the most frequent token is spread over as many groups as there are ranges.

The best hits need few blocks: the bounds of all blocks that touch a range, summed over the tokens, bound the
scores in that range. The most promising ranges are scored first; then only ranges whose bound reaches the worst
of the best hits so far.

Keys should be distinct; a document with a NULL text is not part of the index.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.operators import search
from webtext.operators.lookup import fits_broadcast, lookup, token_counts
from webtext.session import materialise

#: Documents of a range: a power of 2.
RANGE_BITS = 12
RANGE = 1 << RANGE_BITS
BLOCK = 128
#: Ranges that a search scores first.
FIRST_RANGES = 4

_POSTINGS = (
    "token string, first bigint, last bigint, offsets array<bigint>, tfs array<int>, lengths array<int>, "
    "n int, max_tf int, min_length int, segment string, bucket int"
)
_SEGMENTS = "segment string, documents bigint, length bigint, numbers bigint, buckets int, replaces array<string>"


def _range(number: str | Column) -> Column:
    return F.shiftright(F.col(number) if isinstance(number, str) else number, RANGE_BITS)


def _whole_ranges(numbers: int) -> int:
    return -(-numbers // RANGE) * RANGE


def _decoded(blocks: DataFrame, *kept: str) -> DataFrame:
    """``(*kept, number, tf, length)``, one row per posting."""
    rows = F.arrays_zip("offsets", "tfs", "lengths")
    cells = blocks.select(*kept, "first", F.inline_outer(rows))
    return cells.select(*kept, (F.col("first") + F.col("offsets")).alias("number"), F.col("tfs").alias("tf"), F.col("lengths").alias("length"))


@dataclass(frozen=True)
class Index:
    """The index in the folder ``path``; ``buckets`` counts when the first segment is written."""

    spark: SparkSession
    path: str
    buckets: int = 64

    def append(self, documents: DataFrame, column: str, key: str) -> str:
        """Add documents as a segment; its name is returned."""
        texts = documents.filter(F.col(column).isNotNull())
        rows = texts.select(F.col(key).alias("key"), search.tokens(F.col(column)).alias("tokens"), F.monotonically_increasing_id().alias("_at"))
        rows = materialise(rows.withColumn("length", F.size("tokens")), "index-documents")
        # A task's numbers start at its own number times 2^33. Each task's first range follows the last of the task before.
        task, place = F.shiftright("_at", 33).cast("int"), F.col("_at").bitwiseAND((1 << 33) - 1)
        begins, numbers = [], 0
        for of, n in rows.groupBy(task.alias("of")).count().orderBy("of").collect():
            begins.append((of, numbers))
            numbers += _whole_ranges(n)
        begin = self.spark.createDataFrame(begins, "_task int, _begin bigint")
        numbered = rows.join(F.broadcast(begin), task == F.col("_task")).select("key", "length", "tokens", (F.col("_begin") + place).alias("number"))
        counts = token_counts(numbered.select(F.struct("number", "length").alias("_row"), "tokens"), "_row", F.col("tokens"))
        postings = counts.select("token", "_row.number", "tf", "_row.length")
        return self._write(numbered.select("number", "key", "length"), postings, numbers, [])

    def merge(self) -> str:
        """One segment in the place of all; its name is returned."""
        docs, postings, numbers = None, None, 0
        live = self.segments()
        for segment in live:
            name, shift = segment["segment"], F.lit(numbers).cast("bigint")
            more = self.docs().filter(F.col("segment") == name).select((F.col("number") + shift).alias("number"), "key", "length")
            rows = _decoded(self.postings().filter(F.col("segment") == name), "token")
            rows = rows.select("token", (F.col("number") + shift).alias("number"), "tf", "length")
            docs, postings = (docs.union(more), postings.union(rows)) if docs else (more, rows)
            numbers += segment["numbers"]
        if docs is None:
            raise ValueError(f"{self.path} has no segments")
        return self._write(docs, postings, numbers, [segment["segment"] for segment in live])

    def _write(self, docs: DataFrame, postings: DataFrame, numbers: int, replaces: list[str]) -> str:
        name = uuid.uuid4().hex
        docs.write.parquet(f"{self.path}/docs/segment={name}")
        postings = materialise(postings, "index-postings")
        frequent = materialise(postings.groupBy("token").count().filter(F.col("count") > RANGE).select("token", F.lit(True).alias("_frequent")), "index-frequent")
        marked = lookup(postings, frequent, ["token"], "number", how="left")
        grouped = marked.groupBy("token", F.when(F.col("_frequent"), _range("number")).alias("_group")).agg(
            F.sort_array(F.collect_list(F.struct("number", "tf", "length"))).alias("_all")
        )
        begins = F.sequence(F.lit(1), F.size("_all"), F.lit(BLOCK))
        blocks = grouped.select("token", "_group", F.explode_outer(F.transform(begins, lambda i: F.slice("_all", i, F.lit(BLOCK)))).alias("_b"))
        first = F.col("_b")[0]["number"]
        blocks = blocks.select(
            "token",
            "_group",
            first.alias("first"),
            F.element_at("_b", -1)["number"].alias("last"),
            F.transform("_b", lambda p: p["number"] - first).alias("offsets"),
            F.col("_b")["tf"].alias("tfs"),
            F.col("_b")["length"].alias("lengths"),
            F.size("_b").alias("n"),
            F.array_max(F.col("_b")["tf"]).alias("max_tf"),
            F.array_min(F.col("_b")["length"]).alias("min_length"),
            self._bucket(F.col("token")).alias("bucket"),
        )
        # The blocks of frequent tokens go to several files of a bucket, all others to one.
        spread = F.coalesce(F.pmod("_group", F.lit(8)), F.lit(-1))
        dealt = blocks.repartition("bucket", spread).drop("_group").sortWithinPartitions("bucket", "token", "first")
        dealt.write.partitionBy("bucket").parquet(f"{self.path}/postings/segment={name}")
        documents, length = self.spark.read.parquet(f"{self.path}/docs/segment={name}").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        row = [(name, documents, length, numbers, self._buckets(), replaces)]
        self.spark.createDataFrame(row, _SEGMENTS).coalesce(1).write.mode("append").parquet(f"{self.path}/segments")
        return name

    def segments(self) -> list:
        """Rows of the finished segments that no other one replaces."""
        try:
            rows = self.spark.read.schema(_SEGMENTS).parquet(f"{self.path}/segments").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        gone = {name for row in rows for name in row["replaces"]}
        return sorted((row for row in rows if row["segment"] not in gone), key=lambda row: row["segment"])

    def _buckets(self) -> int:
        return next((row["buckets"] for row in self.segments()), self.buckets)

    def _bucket(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self._buckets())).cast("int")

    def postings(self) -> DataFrame:
        return self.spark.read.schema(_POSTINGS).parquet(f"{self.path}/postings")

    def docs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/docs")

    def match(self, text: str) -> "Found":
        """Documents with at least one token of ``text``, ranked by BM25 as in :func:`search.match`."""
        return Found(self, search.analyse(self.spark, text))

    def term(self, value: str) -> "Found":
        """Documents that hold exactly the token ``value``."""
        terms = search.analyse(self.spark, value)
        return Found(self, terms if list(terms) == [value] else Counter())


@dataclass(frozen=True)
class Found:
    """Hits of a search; nothing but the tokens' buckets is read."""

    index: Index
    terms: Counter

    @cached_property
    def blocks(self) -> DataFrame:
        names = sorted(self.terms)
        listed = F.array(*[F.lit(name) for name in names]) if names else F.array().cast("array<string>")
        wanted = self.index.spark.range(1).select(F.transform(listed, self.index._bucket)).first()[0]
        live = [row["segment"] for row in self.index.segments()]
        if not live:
            raise ValueError(f"{self.index.path} has no segments")
        return self.index.postings().filter(
            F.col("segment").isin(live) & F.col("bucket").isin(sorted(set(wanted))) & F.col("token").isin(names)
        )

    def total(self) -> DataFrame:
        """Exact number of matches, one row. For one token the blocks' sizes are enough."""
        if len(self.terms) < 2:
            return self.blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"))
        return _decoded(self.blocks, "segment").select("segment", "number").distinct().agg(F.count("*").alias("total"))

    @cached_property
    def _weights(self) -> tuple[dict[str, float], float]:
        """Weight per token and mean length; one row per query token reaches the driver."""
        rows = self.index.segments()
        documents = sum(row["documents"] for row in rows)
        frequencies = dict(self.blocks.groupBy("token").agg(F.sum("n")).collect())
        weights = {name: self.terms[name] * math.log(1 + (documents - df + 0.5) / (df + 0.5)) for name, df in sorted(frequencies.items())}
        return weights, sum(row["length"] for row in rows) / max(documents, 1)

    def _score(self, tf: str, length: str) -> Column:
        weights, mean = self._weights
        weight = F.coalesce(*[F.when(F.col("token") == name, F.lit(weight)) for name, weight in weights.items()])
        tf = F.col(tf).cast("double")
        return weight * tf / (tf + F.lit(search.K1) * (F.lit(1 - search.B) + F.lit(search.B) * F.col(length) / F.lit(mean)))

    def bounds(self) -> DataFrame:
        """``(segment, range, bound)``: no document of the range scores more."""
        touched = F.explode(F.sequence(_range("first"), _range("last"))).alias("range")
        best = self.blocks.select("segment", "token", self._score("max_tf", "min_length").alias("_s"), touched).groupBy("segment", "range", "token")
        return best.agg(F.max("_s").alias("_s")).groupBy("segment", "range").agg(F.sum("_s").alias("bound"))

    def _scored(self, ranges: DataFrame) -> DataFrame:
        """``(segment, number, score)`` of the matches in ``ranges (segment, range)``."""
        ranges = F.broadcast(ranges) if fits_broadcast(ranges) else ranges
        touched = self.blocks.withColumn("range", F.explode(F.sequence(_range("first"), _range("last"))))
        chosen = touched.join(ranges, ["segment", "range"])
        cells = _decoded(chosen, "segment", "range", "token").filter(_range("number") == F.col("range"))
        cells = cells.select("segment", "number", "token", self._score("tf", "length").alias("_s"))
        # One column a token, added in a fixed order, so that equal documents get equal scores.
        parts = [F.sum(F.when(F.col("token") == name, F.col("_s"))).alias(f"_s{i}") for i, name in enumerate(self._weights[0])]
        summed = cells.groupBy("segment", "number").agg(*parts)
        score = F.lit(0.0)
        for i in range(len(parts)):
            score = score + F.coalesce(f"_s{i}", F.lit(0.0))
        return summed.select("segment", "number", score.alias("_score"))

    def top(self, size: int = 10) -> DataFrame:
        """``(key, _score)`` of the best hits, ties by key."""
        docs = self.index.docs()
        if size < 1 or not self.terms or not self._weights[0]:
            return docs.select("key", F.lit(0.0).alias("_score")).filter(F.lit(False))
        bounds = materialise(self.bounds(), "index-bounds")
        first = materialise(bounds.orderBy(F.desc("bound"), "segment", "range").limit(FIRST_RANGES).select("segment", "range"), "index-ranges")
        least = self._least(self._scored(first), size)
        # Sums in another order may differ in the last digits.
        reaching = bounds.filter(F.col("bound") * (1 + 1e-9) >= least)
        scored = materialise(self._scored(materialise(reaching.select("segment", "range"), "index-ranges")).filter(F.col("_score") >= least), "index-scored")
        hits = scored.filter(F.col("_score") >= self._least(scored, size))
        hits = F.broadcast(hits) if fits_broadcast(hits) else hits
        return docs.join(hits, ["segment", "number"]).select("key", "_score").orderBy(F.desc("_score"), "key").limit(size)

    @staticmethod
    def _least(scored: DataFrame, size: int) -> float:
        """The score of the last of the best ``size`` hits, 0 if there are fewer."""
        best = scored.select("_score").orderBy(F.desc("_score")).limit(size).collect()
        return best[-1]["_score"] if len(best) == size else 0.0
