"""Token ids as files: frames of whole documents in range-coded, checksummed blocks.

Documents are dealt by ranges of their key and sorted, so a file holds a run of documents in
ascending order. A file's rows are frames. A frame holds whole documents (about ``FRAME`` ids, or
one longer document): a header with the documents' keys and numbers of ids, and blocks of at most
``BLOCK`` ids. Each block is coded on its own from an empty model and has a CRC-32 of its ids, so
damage is found and stays in its block. Files are written and read by Spark, as a table with one
binary column per frame, so they can lie in any store.

Frame, little-endian: ``CMR2``, number of documents, number of blocks and size of the vocabulary
(u32 each); per document key (i64), 1 if the key is null (u8), number of ids (u64); per block number
of ids, CRC-32 of the ids as u32, bytes of the code (u32 each); CRC-32 of all before; the codes.

Defined results: null text is empty; documents of equal key stand in the order of their text's hash;
null keys come first; an empty table gives no files' rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtext.llm import rangecoder
from webtext.llm.encode import encoder
from webtext.llm.rows import SLICE_BYTES, binary_column, slices, texts_of
from webtext.session import materialise

BLOCK, FRAME, TOGETHER = 4_096, 65_536, 1_536
#: Words that an encoder of the writer keeps: texts have many rare ones, and each new one goes through the merges.
WORDS = 700_000
FILE = "part int, frame int, start bigint, n_ids bigint, data binary"
_HEAD = struct.Struct("<4sIII")


def pack_frames(frames: list[tuple[list[int | None], np.ndarray, np.ndarray]], vocabulary: int) -> list[bytes]:
    """Frames of ``(keys, numbers of ids, ids)``."""
    blocks, per = [], []
    for _, _, ids in frames:
        cut = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
        blocks += cut
        per.append(len(cut))
    codes = rangecoder.encode(blocks, vocabulary) if blocks else []
    result, at = [], 0
    for (keys, counts, _), n in zip(frames, per):
        own, code = blocks[at : at + n], codes[at : at + n]
        at += n
        table = np.array([(len(b), zlib.crc32(b.astype("<u4").tobytes()), len(c)) for b, c in zip(own, code)], "<u4").reshape(-1, 3)
        head = b"".join(
            (
                _HEAD.pack(b"CMR2", len(keys), n, vocabulary),
                np.array([k or 0 for k in keys], "<i8").tobytes(),
                np.array([k is None for k in keys], np.uint8).tobytes(),
                counts.astype("<u8").tobytes(),
                table.tobytes(),
            )
        )
        result.append(head + struct.pack("<I", zlib.crc32(head)) + b"".join(code))
    return result


def unpack_frames(datas: list[bytes]) -> list[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """The frames again; raises ValueError on damage."""
    heads, codes, sizes, sums, vocabularies = [], [], [], [], set()
    for data in datas:
        magic, docs, blocks, vocabulary = _HEAD.unpack_from(data)
        at = _HEAD.size + 17 * docs + 12 * blocks
        if magic != b"CMR2" or len(data) < at + 4 or zlib.crc32(data[:at]) != struct.unpack_from("<I", data, at)[0]:
            raise ValueError("not a frame, or its header is damaged")
        keys = np.frombuffer(data, "<i8", docs, _HEAD.size)
        null = np.frombuffer(data, np.uint8, docs, _HEAD.size + 8 * docs)
        counts = np.frombuffer(data, "<u8", docs, _HEAD.size + 9 * docs).astype(np.int64)
        table = np.frombuffer(data, "<u4", 3 * blocks, _HEAD.size + 17 * docs).reshape(-1, 3).astype(np.int64)
        heads.append(([None if n else int(k) for k, n in zip(keys, null)], counts, blocks))
        vocabularies.add(vocabulary)
        begin = at + 4
        for n, crc, size in table.tolist():
            codes.append(data[begin : begin + size])
            begin += size
            sizes.append(n)
            sums.append(crc)
    if len(vocabularies) > 1:
        raise ValueError("frames of different vocabularies")
    ids = rangecoder.decode(codes, np.array(sizes, np.int64), vocabularies.pop()) if codes else []
    for block, crc in zip(ids, sums):
        if zlib.crc32(block.astype("<u4").tobytes()) != crc:
            raise ValueError("a block is damaged")
    result, at = [], 0
    for keys, counts, n in heads:
        result.append((keys, counts, np.concatenate(ids[at : at + n]) if n else np.zeros(0, np.uint32)))
        at += n
    return result


def write(docs: DataFrame, path: str, file: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Writes the files of ``docs`` to the folder ``path``: ids of each text, then ``end_id``."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file, WORDS)
        vocabulary = encode.whole.get_vocab_size()
        part, frame, start = TaskContext.get().partitionId(), 0, 0
        waiting: list[tuple[list[int | None], np.ndarray, np.ndarray]] = []
        blocks = 0
        keys: list[int | None] = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> None:
            nonlocal keys, counts, parts, held, blocks
            ids = np.concatenate(parts)
            waiting.append((keys, np.concatenate(counts), ids))
            blocks += -(-len(ids) // BLOCK)
            keys, counts, parts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, frame, start, blocks
            datas = pack_frames(waiting, vocabulary)
            n = np.array([len(ids) for _, _, ids in waiting], np.int64)
            columns = [
                pa.array(np.full(len(n), part, np.int32)),
                pa.array(np.arange(frame, frame + len(n), dtype=np.int32)),
                pa.array(start + np.cumsum(n) - n),
                pa.array(n),
                pa.array(datas, pa.binary()),
            ]
            frame, start, waiting, blocks = frame + len(n), start + int(n.sum()), [], 0
            return pa.RecordBatch.from_arrays(columns, names=["part", "frame", "start", "n_ids", "data"])

        for piece in slices(batches, "text", SLICE_BYTES // 2):
            ids, number = encode.encode_ended(texts_of(piece), end_id)
            names, ends, first = piece.column("doc_id").to_pylist(), np.cumsum(number), 0
            while first < len(names):  # the documents that fill the frame, and the one that ends it
                before = int(ends[first - 1]) if first else 0
                stop = min(len(names), int(np.searchsorted(ends, before + FRAME - held)) + 1)
                keys += names[first:stop]
                counts.append(number[first:stop])
                parts.append(ids[before : ends[stop - 1]])
                held += int(ends[stop - 1]) - before
                first = stop
                if held >= FRAME:
                    close()
                if blocks >= TOGETHER:
                    yield flush()
        if keys:
            close()
        if waiting:
            yield flush()

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ranged = chosen.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(run, FILE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the documents in the files: ``start`` counts the ids of all documents before."""
    frames = spark.read.schema(FILE).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER * BLOCK // FRAME):
                piece = batch.slice(begin, TOGETHER * BLOCK // FRAME)
                found = unpack_frames(piece.column("data").to_pylist())
                docs = np.array([len(keys) for keys, _, _ in found], np.int64)
                counts = np.concatenate([c for _, c, _ in found])
                first = np.repeat(piece.column("start").to_numpy(), docs)
                inner = np.concatenate([np.cumsum(c) - c for _, c, _ in found])
                ids = np.concatenate([i for _, _, i in found])
                columns = [
                    piece.column("part").take(pa.array(np.repeat(np.arange(len(docs)), docs))),
                    pa.array([k for keys, _, _ in found for k in keys], pa.int64()),
                    pa.array(first + inner),
                    pa.array(counts),
                    binary_column(ids.astype("<u4"), counts),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "inner", "n_tokens", "ids"])

    # One row per file: the sum over the files before it.
    sizes = materialise(frames.groupBy("part").agg(F.sum("n_ids").alias("n")), "file-sizes")
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    decoded = frames.mapInArrow(run, "part int, doc_id bigint, inner bigint, n_tokens bigint, ids binary")
    return decoded.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids")
