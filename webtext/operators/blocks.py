"""Rows with token arrays in blocks of bounded size, and what a block needs of a table keyed by word.

A join of every token row with a large table moves the tokens, or the whole table through the driver. A block of rows
holds far fewer distinct words than tokens: only these are joined, and the block's rows meet them in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens of a block on average; a block is held by one task.
BLOCK_TOKENS = 1 << 20


def in_blocks(df: DataFrame, tokens: str, place: Column, least: int = 1, size: int = BLOCK_TOKENS) -> DataFrame:
    """``df``, a written table, with the number of each row's block in ``_block``; at least ``least`` blocks.

    Rows are dealt by a hash of ``place``, which should tell rows apart, so that a block holds about ``size`` tokens.
    """
    held = df.agg(F.sum(F.array_size(tokens))).first()[0] or 0
    count = max(least, -(-held // size))
    return df.withColumn("_block", F.pmod(F.xxhash64(place), F.lit(count)).cast("int"))


#: Distinct words that a task holds while it counts.
HELD_WORDS = 1 << 20


def lists(column: pa.Array) -> pa.Array:
    """Arrays of words; a column of text is split at its spaces first, without empty words."""
    if not pa.types.is_string(column.type):
        return column
    cut = pc.split_pattern(column, " ")
    words = cut.flatten()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if full.all():
        return cut
    of = np.repeat(np.arange(len(cut)), pc.list_value_length(cut).fill_null(0).to_numpy(zero_copy_only=False))[full]
    ends = np.r_[0, np.cumsum(np.bincount(of, minlength=len(cut)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), words.filter(pa.array(full)))


def counted(df: DataFrame, tokens: str, name: str = "word") -> DataFrame:
    """Distinct words of all rows with their count: ``(name, n)``; a task counts in its batches first.

    ``tokens`` is a column of arrays, or of text with single spaces between words, which reaches the task faster.
    """

    def merged(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            found = lists(batch.column(0)).flatten().drop_null().value_counts()
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            if sum(table.num_rows for table in held) > HELD_WORDS:
                held = [merged(held)]
                if held[0].num_rows > HELD_WORDS // 2:
                    yield from held[0].combine_chunks().to_batches()
                    held = []
        if held:
            yield from merged(held).combine_chunks().to_batches()

    found = df.select(tokens).mapInArrow(run, "word string, n bigint")
    return found.groupBy(F.col("word").alias(name)).agg(F.sum("n").alias("n"))


def words(rows: DataFrame, tokens: str) -> DataFrame:
    """Distinct words of each block with their count: ``(_in, word, n)``."""
    every = rows.select(F.col("_block").alias("_in"), F.explode_outer(tokens).alias("word")).filter(F.col("word").isNotNull())
    return every.groupBy("_in", "word").agg(F.count("*").alias("n"))


def flat(column: pa.ChunkedArray, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``known`` of all tokens of a column of arrays, -1 if not there, and the tokens per row."""
    lists = column.combine_chunks()
    places = pc.index_in(lists.flatten(), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
    return places, pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
