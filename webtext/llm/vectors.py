"""Vectors that take part in comparisons, and groups of sorted Arrow rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    vector = F.col(column)
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", *more: str) -> DataFrame:
    """``(vec_id, embedding array<double>, *more)`` of the rows whose vector takes part."""
    chosen = table.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"), *more)
    return chosen.filter(usable("embedding"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def sorted_groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` (no nulls), also over batch borders; the rows must come sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for begin, end in zip(cuts, cuts[1:]):
            yield table.slice(begin, end - begin)
        rest = table.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest
