"""Word vectors from co-occurrence counts; counts, weights and vectors are tables, and no model is on the driver.

Words that stand within a window are counted as pairs of numbers: rows go in chunks whose distinct words get the numbers
of the whole vocabulary, and a chunk's pairs travel as sorted, packed numbers. Positive shifted pointwise mutual
information weighs them: a sparse symmetric table. Its best approximation of low rank comes from
alternating least squares. The fixed factor is kept orthonormal, so each half-step is the product of the sparse
table with the factor: weights go in blocks by word, and a vector goes once to each block that needs it. The
orthonormal form needs the factor's product with itself, ``size * size`` numbers, which tasks sum up in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.operators import blocks
from webtext.operators.embedding import WordVectors
from webtext.operators.lookup import lookup
from webtext.operators.sparse import numbered
from webtext.session import discard, materialise

#: Weights of a block on average; a block is held by one task.
BLOCK_WEIGHTS = 1 << 20
#: Tokens of a chunk of rows; pairs of chunks that a task puts together, on average.
CHUNK_TOKENS = 1 << 20
PART_PAIRS = 1 << 21
#: Blocks are packed and multiplied in so many turns: what one turn shuffles is gone before the next.
TURNS = 4


def pairs(df: DataFrame, tokens: str, window: int = 5) -> DataFrame:
    """``(a, b, n)``: how often ``b`` stands within ``window`` words of ``a``, before or behind it.

    ``tokens`` is a column of arrays, or of text with single spaces between words.
    """
    vocabulary, counted = _half(df, tokens, window)
    return _both(_named(counted.filter("a > 0"), vocabulary), "n")


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: small numbers are mostly zeros then, which pack well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _chunks(df: DataFrame, tokens: str) -> DataFrame:
    """Rows of words in chunks, a written row each: the distinct words with their counts, the most frequent first, and
    the place of each token among them, from 1 on; 0 is a missing word. ``lengths`` has the tokens of each row."""

    def coded(held: list[pa.Array]) -> pa.RecordBatch:
        lists = pa.concat_arrays(held)
        words = lists.flatten().dictionary_encode()
        at = words.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        counts = np.bincount(at + 1, minlength=len(words.dictionary) + 1)[1:]
        order = np.argsort(-counts, kind="stable")
        place = np.zeros(len(order) + 1, np.int32)
        place[order + 1] = np.arange(1, len(order) + 1)
        lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
        names = words.dictionary.take(pa.array(order))
        row = [pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), x) for x in (names, pa.array(counts[order]))]
        row += [pa.array([_planes(x)], pa.binary()) for x in (place[at + 1], lengths)]
        return pa.RecordBatch.from_arrays(row, names=["words", "counts", "ids", "lengths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                lists = blocks.lists(batch.column(0).slice(begin, 512))
                held.append(lists)
                size += len(lists.flatten())
                if size >= CHUNK_TOKENS:
                    yield coded(held)
                    held, size = [], 0
        if size:
            yield coded(held)

    found = df.select(tokens).mapInArrow(run, "words array<string>, counts array<bigint>, ids binary, lengths binary")
    return materialise(found.withColumn("_chunk", F.monotonically_increasing_id()), "chunks")


def _half(df: DataFrame, tokens: str, window: int, min_count: int = 1) -> tuple[DataFrame, DataFrame]:
    """The vocabulary ``(word, number)``, written, and the pairs ``(a, b, n)`` of its numbers with ``a <= b``, written.

    Under ``a = 0`` stands how often ``b`` is one of a pair. Words with fewer than ``min_count`` occurrences have no number.
    """
    chunks = _chunks(df, tokens)
    total = (chunks.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // 4
    every = chunks.select(F.inline(F.arrays_zip(F.col("words").alias("term"), F.col("counts").alias("n"))))
    frequent = materialise(every.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count).select("term"), "frequent-words")
    used = [frequent]
    vocabulary = materialise(numbered(frequent, used).withColumnRenamed("term", "word"), "vocabulary")
    discard(*used)
    base = vocabulary.count() + 1
    parts = -(-total * window // PART_PAIRS) or 1
    known = chunks.select(F.col("_chunk").alias("_in"), F.posexplode("words").alias("at", "word")).join(vocabulary, "word").select("_in", "at", "number")

    def count(chunk: pa.Table, known: pa.Table) -> pa.Table:
        codes = []
        if chunk.num_rows:
            number = np.zeros(len(chunk["words"][0].values) + 1, np.int64)
            number[known["at"].to_numpy() + 1] = known["number"].to_numpy()
            ids = number[_numbers(chunk["ids"][0].as_py(), np.int32)]
            lengths = _numbers(chunk["lengths"][0].as_py(), np.int32)
            of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            for gap in range(1, window + 1):
                x, y = ids[:-gap], ids[gap:]
                near = (of[:-gap] == of[gap:]) & (x > 0) & (y > 0)
                x, y = x[near], y[near]
                codes += [np.minimum(x, y) * base + np.maximum(x, y), x, y]
        found, n = np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]), return_counts=True)
        part = (found.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        found, n, part = found[order], n[order].astype(np.int32), part[order].astype(np.int32)
        begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
        ends = np.r_[begins[1:], len(part)].astype(int)
        steps = [np.diff(found[i:j], prepend=0) for i, j in zip(begins, ends)]
        columns = [[pa.compress(_planes(x), codec="zstd", asbytes=True) for x in given] for given in (steps, [n[i:j] for i, j in zip(begins, ends)])]
        return pa.table([pa.array(part[begins]), pa.array((ends - begins).astype(np.int32)), *[pa.array(x, pa.binary()) for x in columns]], names=["part", "size", "codes", "n"])

    def merge(rows: pa.Table) -> pa.Table:
        def unpacked(name: str, kind: type) -> list[np.ndarray]:
            width = np.dtype(kind).itemsize
            return [_numbers(pa.decompress(x, size * width, codec="zstd", asbytes=True), kind) for x, size in zip(rows[name].to_pylist(), rows["size"].to_pylist())]

        codes, n = np.concatenate([np.cumsum(x) for x in unpacked("codes", np.int64)]), np.concatenate(unpacked("n", np.int32))
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        begins = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        return pa.table({"a": codes[begins] // base, "b": codes[begins] % base, "n": np.add.reduceat(n[order].astype(np.int64), begins)})

    packed = chunks.select("_chunk", "words", "ids", "lengths").groupBy("_chunk").cogroup(known.groupBy("_in"))
    packed = packed.applyInArrow(count, "part int, size int, codes binary, n binary")
    counted = materialise(packed.groupBy("part").applyInArrow(merge, "a bigint, b bigint, n bigint"), "word-pairs")
    discard(chunks)
    return vocabulary, counted


def _named(half: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Words in place of the numbers of pairs."""
    for side, other in (("a", "b"), ("b", "a")):
        names = vocabulary.select(F.col("number").alias(side), F.col("word").alias(f"_{side}"))
        half = lookup(half, names, [side], other)
    return half.drop("a", "b").withColumnsRenamed({"_a": "a", "_b": "b"})


def _both(half: DataFrame, value: str) -> DataFrame:
    """Both orders of the pairs; a count of a word near itself is doubled, as it was met from both sides."""
    one = 2 * F.col("n") if value == "n" else F.col(value)
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", one.alias(value)))).otherwise(
        F.array(F.struct("a", "b", value), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), value))
    )
    return half.select(F.inline(both))


def shifted_pmi(df: DataFrame, tokens: str, window: int = 5, min_count: int = 1, shift: float = 1.0) -> DataFrame:
    """``(a, b, pmi)``: ``ln(n(a, b) * n / (n(a) * n(b))) - ln(shift)`` where that is positive.

    ``tokens`` is as for :func:`pairs`. Words with fewer than ``min_count`` occurrences are left out of the pairs; the window counts all words.
    """
    vocabulary, counted = _half(df, tokens, window, min_count)
    return _both(_named(_weights(counted, shift), vocabulary), "pmi")


def _weights(counted: DataFrame, shift: float) -> DataFrame:
    """``(a, b, pmi)`` of the numbered pairs with a positive weight, in one order."""
    # A word near itself counts twice, once in either order.
    sums = counted.filter("a = 0").select(F.col("b").alias("a"), F.col("n").alias("_n"))
    total = sums.agg(F.sum("_n").cast("double")).scalar()
    found = lookup(counted.filter("a > 0"), sums.toDF("a", "_na"), ["a"], "b")
    found = lookup(found, sums.toDF("b", "_nb"), ["b"], "a")
    met = F.when(F.col("a") == F.col("b"), 2 * F.col("n")).otherwise(F.col("n"))
    pmi = F.ln(met * total / (F.col("_na").cast("double") * F.col("_nb"))) - F.ln(F.lit(float(shift)))
    return found.select("a", "b", pmi.alias("pmi")).filter("pmi > 0")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _gram(factor: DataFrame, size: int) -> np.ndarray:
    """The factor's product with itself, summed by tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            rows = _matrix(batch)
            total += rows.T @ rows
        at = np.arange(size * size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "x"])

    summed = factor.select("vector").mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    result = np.zeros(size * size)
    for at, x in summed:
        result[at] = x
    return result.reshape(size, size)


def _orthonormal(factor: DataFrame, size: int) -> DataFrame:
    """The factor times the inverse root of its product with itself; directions without weight become zero."""
    values, vectors = np.linalg.eigh(_gram(factor, size))
    weight = np.where(values > max(values[-1], 0.0) * 1e-12, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    root = (vectors * weight) @ vectors.T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = (_matrix(batch) @ root).ravel()
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * size
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["word", "vector"])

    kind = factor.schema["word"].dataType.simpleString()
    return materialise(factor.mapInArrow(run, f"word {kind}, vector array<double>"), "factor")


def _packed(rows: pa.Table) -> pa.Table:
    """A block's weights as one row: its words with the places where each one's weights end, the distinct words that they
    are weights for, and per weight the place of that word and the value."""
    words, near = rows["a"].combine_chunks().dictionary_encode(), rows["b"].combine_chunks().dictionary_encode()
    of = words.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=len(words.dictionary))).astype(np.int32)
    at, pmi = near.indices.to_numpy(zero_copy_only=False)[order].astype(np.int32), rows["pmi"].to_numpy()[order]
    row = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (words.dictionary, pa.array(ends), near.dictionary)]
    return pa.table([rows["_block"].slice(0, 1), *row, *[pa.array([_planes(x)], pa.binary()) for x in (at, pmi)]], names=["_block", "words", "ends", "near", "at", "pmi"])


def _dealt(weights: DataFrame, count: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The weights in blocks by ``a``, a written row each, and the distinct ``(_in, word)`` whose vectors a block needs."""
    count = count or -(-weights.count() // BLOCK_WEIGHTS) or 1
    kind = weights.schema["a"].dataType.simpleString()
    schema = f"_block int, words array<{kind}>, ends array<int>, near array<{kind}>, at binary, pmi binary"
    rows = weights.withColumn("_block", _block(count)).groupBy("_block").applyInArrow(_packed, schema)
    rows = materialise(rows, "weight-blocks")
    return rows, rows.select(F.col("_block").alias("_in"), F.explode("near").alias("word"))


def _block(count: int):
    return F.pmod(F.xxhash64("a"), F.lit(count)).cast("int")


def _product(rows: DataFrame, needs: DataFrame, factor: DataFrame, size: int) -> DataFrame:
    """The sparse table times the factor: ``(word, vector)``.

    A block has all weights of its words, so its sums are whole, and a vector goes once to each block that needs it.
    """

    kind = factor.schema["word"].dataType.simpleString()

    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        words, near = (rows[name].combine_chunks().flatten() for name in ("words", "near"))
        ends = rows["ends"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        at, pmi = (_numbers(b"".join(rows[name].to_pylist()), x) for name, x in (("at", np.int32), ("pmi", np.float64)))
        # A vector that is not there, as that of a word without weights, counts as zeros.
        vectors = np.vstack([held["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size), np.zeros((1, size))])
        place = pc.index_in(near, value_set=held["word"].combine_chunks()).fill_null(-1).to_numpy(zero_copy_only=False)
        at, of = place[at], np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        sums = np.zeros((len(words), size))
        for begin in range(0, len(of), 1 << 15):
            some = slice(begin, begin + (1 << 15))
            first = np.flatnonzero(np.r_[True, of[some][1:] != of[some][:-1]])
            sums[of[some][first]] += np.add.reduceat(vectors[at[some]] * pmi[some, None], first)
        ends = np.arange(len(sums) + 1, dtype=np.int32) * size
        return pa.table({"word": words, "vector": pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel()))})

    held = needs.join(factor, "word")
    summed = rows.groupBy("_block").cogroup(held.groupBy("_in")).applyInArrow(run, f"word {kind}, vector array<double>")
    return materialise(summed, "factor")


def train(
    df: DataFrame, tokens: str, size: int = 100, window: int = 5, min_count: int = 1, shift: float = 1.0, rounds: int = 6
) -> WordVectors:
    """Vectors of the words with ``min_count`` occurrences; a word without a positive weight gets zeros."""
    vocabulary, counted = _half(df.filter(F.col(tokens).isNotNull()), tokens, window, min_count)
    weights = materialise(_weights(counted, shift), "pmi")
    discard(counted)
    both = _both(weights, "pmi")
    count = -(-2 * weights.count() // BLOCK_WEIGHTS) or 1
    # A start that depends on the word alone.
    start = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.xxhash64("word", i) / F.lit(float(1 << 63)))
    ends = weights.select(F.explode(F.array("a", "b")).alias("number")).distinct()
    factor = materialise(ends.join(vocabulary, "number").select(F.col("number").alias("word"), start.alias("vector")), "factor")
    turns = min(TURNS, count)
    dealt = [_dealt(both.filter(F.pmod(_block(count), F.lit(turns)) == turn), count) for turn in range(turns)]
    discard(weights)
    products: list[DataFrame] = [factor]
    for _ in range(rounds):
        fixed = _orthonormal(factor, size)
        discard(*products)
        products = [_product(rows, needs, fixed, size) for rows, needs in dealt]
        discard(fixed)
        factor = reduce(DataFrame.union, products)
    zeros = F.array_repeat(F.lit(0.0), size)
    named = vocabulary.join(factor.withColumnRenamed("word", "number"), "number", "left")
    table = materialise(named.select("word", F.coalesce("vector", zeros).alias("vector")), "word-vectors")
    discard(vocabulary, *products, *[rows for rows, _ in dealt])
    return WordVectors(table, size)


def neighbours(vectors: WordVectors, word: str, k: int = 10) -> DataFrame:
    """``(word, cosine)`` of the ``k`` nearest other words."""
    dot = F.aggregate(F.zip_with("vector", "_v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    of = vectors.table.filter(F.col("word") == word).select(F.col("vector").alias("_v"))
    others = vectors.table.filter(F.col("word") != word).join(F.broadcast(of))  # one row
    scored = others.select("word", (dot / F.nullif(norm(F.col("vector")) * norm(F.col("_v")), F.lit(0.0))).alias("cosine"))
    return scored.filter("cosine IS NOT NULL").orderBy(F.desc("cosine"), "word").limit(k)
