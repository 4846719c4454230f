"""Arrow batches as bounded slices, and small helpers for building output batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Characters (bytes) of text that are worked on at once. A longer single text is a slice of its own.
SLICE_BYTES = 2_000_000


#: What operators keep in a worker process from task to task. Stages that come before them in a pipeline empty it, so
#: that the workers, which live on, do not add up the caches of all stages.
worker_caches: dict[object, object] = {}


def tidy() -> None:
    """Give freed memory of a worker that has run other tasks back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def emptied() -> None:
    """At the begin of a task of another operator: drop what the worker keeps, and give its memory back."""
    worker_caches.clear()
    tidy()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, in slices whose ``column`` holds about ``limit`` bytes at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; null becomes the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


def kept(docs: DataFrame, text: str, judge: Callable[[], Callable[[list[str]], np.ndarray]], named: str | None = None) -> DataFrame:
    """The rows of ``docs``, with all columns, for which a judge made once per task says True to the text.

    With ``named`` the judge says True and a name to each text, and the name replaces the column's value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emptied()
        decide = judge()
        # Stages that filter run one after another in the same workers: smaller slices leave them smaller.
        for part in slices(batches, text, SLICE_BYTES // 2):
            found = decide(texts_of(part, text))
            if named is not None:
                found, names = found
                at = part.schema.get_field_index(named)
                part = part.set_column(at, part.schema.field(at), pa.array(names, part.schema.field(at).type))
            yield part.filter(pa.array(found, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def binary_column(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per count, cut from the bytes of ``data`` one after another."""
    data = np.ascontiguousarray(data)
    ends = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(np.asarray(counts) * data.itemsize, out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0]+1, ...`` (counts[0] numbers), then the same for the next, in one array."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    shift = np.asarray(starts, dtype=np.int64) - (np.cumsum(counts) - counts)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, counts)
