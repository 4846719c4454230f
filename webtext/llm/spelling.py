"""Spelling variants: words one edit apart, found by PartEnum signatures over letter multisets.

A word's letters form a multiset, that is a binary vector with one place per (letter, occurrence). Words one
replaced code point apart have equal lengths and vectors two places apart; words one inserted or deleted
code point apart differ by one in length and one place. The alphabet is cut into four parts. Vectors that
differ in d places differ in at most d parts, so they agree on the letters of some four - d parts: each word gives one
signature for every choice of parts that are left out (six for d = 2, four for d = 1), and words
one edit apart share one. One edit also leaves the word's first or its second half as it is, so each
signature is split by the half that stays, which keeps anagrams apart. Equal signatures are joined and the
edit is verified inside the join.

A signature with more than ``LARGE`` words is split again, by the word without one of its code points: words
one replacement apart share such a rest, and a shorter word is one itself. At most as many words as the alphabet
has letters share a rest, so no group grows with the vocabulary.

Signatures are 64-bit hashes; as the edit is verified, a clash costs time only.

Defined results: null and empty texts have no runs; a null key counts as the empty text before the colon; equal
rows count as often as they stand; an empty table gives no rows. Other columns of the input are not read. Texts are taken
in slices, a longer one on its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.rows import ranges, slices
from webtext.llm.words import mix
from webtext.session import materialise

#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 after bytes.lower, which touches A-Z only.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
DAMAGED = 97
LETTERS, OCCURRENCES = 5, 3
PARTS = 4
#: Signatures with more words than this are split by the words' rests.
LARGE = 48
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
# Letters by falling frequency in European text, so that parts hold about equally many.
_FREQUENT = "etaoinsrhldcumfpgwybvkxjqz"


def damaged(run: bytes, h: int) -> bytes:
    """``run`` without its code point number ``h`` (counted round)."""
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, n)`` of the words of a task, in parts; a word may come more than once."""
    held: Counter[bytes] = Counter()

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for part in slices(batches, "text"):
        for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
            if not text:
                continue
            runs = RUN.findall(text.encode("utf-8", "surrogatepass").lower())
            held.update(runs)
            start = crc32(f"{key}:".encode() if key is not None else b":")
            for run in set(runs):
                h = crc32(run, start)
                if not h % DAMAGED:
                    n = runs.count(run)
                    held[run] -= n
                    held[damaged(run, h)] += n
        if len(held) > HELD:
            yield made()
            held.clear()
    if held:
        yield made()


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """``(word, n)`` of the words with so many code points and occurrences at least."""
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    parts = chosen.mapInArrow(_counted, "word string, n bigint").filter(F.char_length("word") >= letters)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _part(code: np.ndarray) -> np.ndarray:
    """The part of each code point: letters by frequency dealt to and fro, others by code point."""
    table = np.arange(256) % PARTS
    for i, letter in enumerate(_FREQUENT):
        table[ord(letter)] = i % PARTS if i // PARTS % 2 == 0 else PARTS - 1 - i % PARTS
    return table[code & 255]


def _summed(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums (round 2^64) of consecutive stretches that end at ``ends``."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return np.diff(total[np.concatenate(([0], ends))])


def signatures(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(place of the word, side, key)``: all keys; words that may be one edit apart share one.

    Side 0 meets its own kind (one replacement), side 1 as the shorter word meets side 2 as the longer one.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(size)
    letter, part = mix(code.astype(np.uint64) + np.uint64(1 << 32)), _part(code)
    sums = np.stack([_summed(np.where(part == p, letter, np.uint64(0)), ends) for p in range(PARTS)])
    total = sums.sum(axis=0, dtype=np.uint64)

    def halves(shorter: np.ndarray) -> list[np.ndarray]:
        """Hashes of the first ``shorter // 2`` code points and of the last ``shorter - shorter // 2``."""
        first = shorter // 2
        found = []
        for begin, n in ((ends - size, first), (ends - (shorter - first), shorter - first)):
            at = ranges(np.zeros(len(n), np.int64), n)
            stretch = mix(letter[ranges(begin, n)] + mix(at.astype(np.uint64)))
            found.append(_summed(stretch, np.cumsum(n)) + np.uint64(len(found)))
        return found

    own, less = halves(size), halves(size - 1)
    out = []
    for left_out in combinations(range(PARTS), 2):
        kept = mix(total - sums[left_out[0]] - sums[left_out[1]] + np.uint64(left_out[0] * PARTS + left_out[1] + 100))
        out += [(0, kept ^ mix(half + size.astype(np.uint64))) for half in own]
    for p in range(PARTS):
        kept = mix(total - sums[p] + np.uint64(p + 200))
        out += [(1, kept ^ mix(half + size.astype(np.uint64))) for half in own]
        out += [(2, kept ^ mix(half + (size - 1).astype(np.uint64))) for half in less]
    place = np.tile(np.arange(len(words)), len(out))
    return place, np.repeat(np.array([side for side, _ in out], np.int8), len(words)), np.concatenate([key for _, key in out]).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        place, side, key = signatures(batch.column("word").to_pylist())
        place = pa.array(place)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side), batch.column("word").take(place), batch.column("n").take(place)], names=["key", "side", "word", "n"])


def _rests() -> Column:
    """What words of a large signature share if they are one edit apart."""
    word, size = F.col("word"), F.char_length("word")

    def without(i: Column, mark: Column) -> Column:
        return F.concat(F.substr(word, F.lit(1), i), mark, F.substr(word, i + 2))

    places = F.sequence(F.lit(0), size - 1)
    replaced = F.transform(places, lambda i: without(i, F.lit(" ")))
    deleted = F.array_distinct(F.transform(places, lambda i: without(i, F.lit(""))))
    return F.when(F.col("side") == 0, replaced).when(F.col("side") == 1, F.array(word)).otherwise(deleted)


def _pairs(rows: DataFrame, *on: str) -> DataFrame:
    """``(a, na, b, nb)`` of words one edit apart among ``rows (on..., side, word, n)`` with equal ``on``."""
    left = rows.filter("side < 2").select(*on, F.col("side").alias("_side"), F.col("word").alias("a"), F.col("n").alias("na"))
    right = rows.filter("side <> 1").select(*on, F.col("side").alias("_other"), F.col("word").alias("b"), F.col("n").alias("nb"))
    fits = ((F.col("_side") == 0) & (F.col("_other") == 0) & (F.col("a") < F.col("b"))) | ((F.col("_side") == 1) & (F.col("_other") == 2))
    same = [left[name] == right[name] for name in on]
    joined = left.join(right, [*same, fits & (F.levenshtein("a", "b", 1) == 1)])
    return joined.select("a", "na", "b", "nb")


def near(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: each word with each word one edit apart, from ``words (word, n)`` with distinct words."""
    signed = words.mapInArrow(_signed, "key bigint, side tinyint, word string, n bigint")
    same = Window.partitionBy("key")
    sized = signed.withColumn("size", F.count("*").over(same)).withColumn("sides", F.max("side").over(same) - F.min("side").over(same))
    shared = materialise(sized.filter("size > 1 AND (sides > 0 OR side = 0)").drop("sides"), "spelling-signatures")
    large = shared.filter(F.col("size") > LARGE).withColumn("rest", F.explode(_rests()))
    pairs = _pairs(shared.filter(F.col("size") <= LARGE), "key").union(_pairs(large, "key", "rest"))
    pairs = materialise(pairs, "spelling-pairs")
    both = pairs.toDF("word", "n", "near", "near_n").union(pairs.select("b", "nb", "a", "na"))
    return both.repartition("word").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms (word, form)``, which hold no cycle: each round doubles the steps that a word has gone."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = materialise(at.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        at = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for ``words (word, n)``.

    A word's form is its near word of largest ``n`` (ties: the smallest in code-point order) if that is
    ``ratio`` times its own at least; the root is where the forms lead.
    """
    words = materialise(words, "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("_n"), F.col("near").alias("near"))).alias("_best")
    grouped = near(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    grouped = materialise(grouped.select("word", "n_near", F.col("_best.near").alias("form"), (-F.col("_best._n")).alias("form_n")), "spelling-near")
    joined = words.join(grouped, "word", "left").withColumn("_has", F.col("form_n") >= ratio * F.col("n"))
    found = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("_has"), F.col("form")).alias("form"),
        F.when(F.col("_has"), F.col("form_n")).alias("form_n"),
    )
    found = materialise(found, "spelling-forms")
    led = roots(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(led, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
