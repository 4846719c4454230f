"""Best-fit packing by bin completion.

Pieces of at most ``capacity`` tokens have at most ``capacity`` different lengths, so the whole
packing problem, whatever the number of documents, is a table of one count per length. That table
is made by a partially aggregated count; the branch-and-bound works on it and gives patterns (which
lengths share a sequence, and how often). The pieces themselves never leave their executors: a piece
gets its rank among the pieces of its length by two-level counting (hash bucket, then place within
the bucket), and rank and length look up sequence and offset.

The search goes from the largest length down. For it, the fillings of the rest of a sequence are
enumerated, dominated ones dropped, those with the least waste kept and applied as often as the
counts allow, so each step uses up a length and a solution has at most ``capacity`` steps. A branch
ends when the sequences so far and a lower bound of the rest reach the incumbent. The first
incumbent is best-fit decreasing, and best fit completes partial solutions on the way.

Defined results: null text is empty and still one piece (the end id); equal rows are packed as often
as they occur; an empty table gives no rows; columns other than key and text are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.encode import encoder
from webtext.llm.rows import SLICE_BYTES, binary_column, slices, texts_of
from webtext.session import materialise

Filling = tuple[int, ...]

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def cut_documents(
    docs: DataFrame, file: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text", by: str | None = None
) -> DataFrame:
    """Token ids of each document with ``end_id`` at the end, in pieces of at most ``capacity``.

    ``ids`` holds little-endian unsigned 32-bit numbers. The text column ``by``, if named, is carried.
    """
    carried = [] if by is None else [by]
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    for name in carried:
        schema = schema.append(pa.field(name, pa.string()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file)
        for part in slices(batches, "text", SLICE_BYTES // 2):
            ids, counts = encode.encode_ended(texts_of(part), end_id)
            pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(capacity, counts[doc] - start)
            columns = [
                part.column("doc_id").take(pa.array(doc)),
                pa.array(number.astype(np.int32)),
                pa.array(start),
                pa.array(length),
                binary_column(ids.astype("<u4"), length),
                *[part.column(name).take(pa.array(doc)) for name in carried],
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *[F.col(name).cast("string") for name in carried])
    return chosen.mapInArrow(cut, ", ".join([PIECES, *[f"`{name}` string" for name in carried]]))


class Search:
    """Bin completion over counts per length."""

    def __init__(self, counts: dict[int, int], capacity: int, width: int = 4, nodes: int = 12_000):
        if any(not 0 < length <= capacity for length in counts):
            raise ValueError(f"lengths must lie in 1..{capacity}")
        self.capacity, self.width, self.nodes = capacity, width, nodes
        self.counts = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.counts[length] += n

    def lower_bound(self, counts: np.ndarray) -> int:
        """Sequences that any packing needs: by total, and by the pieces too long to share with those above a limit."""
        lengths = np.arange(self.capacity + 1)
        total = int((counts * lengths).sum())
        bound = -(-total // self.capacity)
        above = np.concatenate((np.cumsum(counts[::-1])[::-1], [0]))
        mass = np.concatenate(([0], np.cumsum(counts * lengths)))
        half = self.capacity // 2
        limits = np.arange(half + 1)
        alone = above[self.capacity - limits + 1]
        paired = above[half + 1] - alone
        middle = mass[self.capacity - limits + 1] - mass[limits]
        more = np.maximum(0, -(-(middle - paired * self.capacity) // self.capacity))
        return max(bound, int((alone + paired + more).max()))

    def best_fit(self, counts: np.ndarray) -> list[tuple[int, Filling]]:
        """Best-fit decreasing, many equal pieces at a time."""
        open_bins: dict[int, list[tuple[int, Filling]]] = {}
        for length in np.flatnonzero(counts)[::-1].tolist():
            left = int(counts[length])
            while left:
                rooms = [room for room in open_bins if room >= length]
                if rooms:
                    room = min(rooms)
                    group = open_bins[room]
                    n, filling = group.pop()
                    if not group:
                        del open_bins[room]
                    if n > left:
                        open_bins.setdefault(room, []).append((n - left, filling))
                        n = left
                    open_bins.setdefault(room - length, []).append((n, (*filling, length)))
                    left -= n
                    continue
                each = self.capacity // length
                full, rest = divmod(left, each)
                if full:
                    open_bins.setdefault(self.capacity - each * length, []).append((full, (length,) * each))
                if rest:
                    open_bins.setdefault(self.capacity - rest * length, []).append((1, (length,) * rest))
                left = 0
        return [bin_ for group in open_bins.values() for bin_ in group]

    def fillings(self, counts: np.ndarray, first: int) -> list[Filling]:
        """Undominated fillings of a sequence that begins with ``first``, least waste first."""
        room = self.capacity - first
        have = np.flatnonzero(counts[: room + 1])
        if not len(have):
            return [()]
        below = np.zeros(room + 1, np.int64)  # the longest piece that fits into a room
        below[have] = have
        below = np.maximum.accumulate(below)
        found: dict[Filling, int] = {(int(have[-1]),): int(have[-1])}
        longer = have[::-1]
        partner = np.minimum(below[room - longer], longer)
        once = (partner == longer) & (counts[longer] < 2)
        partner[once] = below[longer[once] - 1]
        ok = partner > 0
        longer, partner = longer[ok], partner[ok]
        for i in np.argsort(room - longer - partner, kind="stable")[: self.width].tolist():
            found[(int(longer[i]), int(partner[i]))] = int(longer[i] + partner[i])
        if max(found.values()) < room:
            self._deeper(counts, have[::-1].tolist(), below, room, found)
        ranked = sorted(found, key=lambda f: (room - found[f], len(f), tuple(-x for x in f)))
        kept: list[Filling] = []
        for filling in ranked:
            if len(kept) < self.width and not any(_dominates(better, filling) for better in kept):
                kept.append(filling)
        return kept

    def _deeper(self, counts: np.ndarray, have: list[int], below: np.ndarray, room: int, found: dict[Filling, int]) -> None:
        """Fillings of three pieces and more, depth first, until one leaves no waste or the step limit is reached."""
        steps = 400
        best = max(found.values())
        stack: list[tuple[int, int, Filling]] = [(0, room, ())]
        while stack and steps:
            at, left, filling = stack.pop()
            steps -= 1
            while at < len(have) and have[at] > left:
                at += 1
            if at == len(have):
                if filling and room - left >= best:
                    found[filling] = room - left
                    best = room - left
                    if best == room:
                        return
                continue
            length = have[at]
            stack.append((at + 1, left, filling))
            for n in range(1, min(int(counts[length]), left // length) + 1):
                stack.append((at + 1, left - n * length, (*filling, *(length,) * n)))

    def solve(self) -> list[tuple[int, Filling]]:
        """``(how often, lengths)`` of each kind of sequence."""
        best = self.best_fit(self.counts)
        incumbent = sum(n for n, _ in best)
        bound = self.lower_bound(self.counts)
        counts = self.counts.copy()
        path: list[tuple[int, Filling]] = []
        options: list[list[tuple[int, Filling]]] = []
        used, nodes, since = 0, 0, 0
        forward = True
        while incumbent > bound and nodes < self.nodes:
            if forward:
                lengths = np.flatnonzero(counts)
                if not len(lengths):
                    if used < incumbent:
                        incumbent, best = used, list(path)
                    forward = False
                    continue
                if used + self.lower_bound(counts) >= incumbent:
                    forward = False
                    continue
                since += 1
                if since % 256 == 0:
                    rest = self.best_fit(counts)
                    if used + sum(n for n, _ in rest) < incumbent:
                        incumbent, best = used + sum(n for n, _ in rest), [*path, *rest]
                        continue
                first = int(lengths[-1])
                counts[first] -= 1
                kinds = [(first, *filling) for filling in self.fillings(counts, first)]
                counts[first] += 1
                options.append([(self._times(counts, kind), kind) for kind in reversed(kinds)])
            elif not options:
                break
            else:
                n, kind = path.pop()
                for length in kind:
                    counts[length] += n
                used -= n
            if not options[-1]:
                options.pop()
                forward = False
                if not path:
                    break
                continue
            n, kind = options[-1].pop()
            for length in kind:
                counts[length] -= n
            path.append((n, kind))
            used += n
            nodes += 1
            forward = True
        return best

    @staticmethod
    def _times(counts: np.ndarray, kind: Filling) -> int:
        return min(int(counts[length]) // kind.count(length) for length in set(kind))


def _dominates(better: Filling, filling: Filling) -> bool:
    """Whether the pieces of ``filling`` fit into those of ``better`` (first fit, longest first)."""
    rooms = sorted(better, reverse=True)
    for length in sorted(filling, reverse=True):
        for i, room in enumerate(rooms):
            if room >= length:
                rooms[i] -= length
                break
        else:
            return False
    return True


def places(kinds: list[tuple[int, Filling]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, first_rank, last_rank, sequence, offset, per_sequence)``: where pieces of a length go, by rank.

    The size is bounded by the capacity alone: every step of the search and of best fit uses up a
    length or a kind, so there are at most 3 * capacity kinds, each with at most sqrt(2 * capacity)
    different lengths. For 4096, random lengths give about 15,000 rows.
    """
    rows, taken, sequence = [], {}, 0
    for n, kind in kinds:
        offset = 0
        for length in sorted(set(kind), reverse=True):
            each = kind.count(length)
            first = taken.get(length, 0)
            rows.append((length, first, first + n * each - 1, sequence, offset, each))
            taken[length] = first + n * each
            offset += each * length
        sequence += n
    return rows


def pack(pieces: DataFrame, capacity: int, ties: tuple[str | Column, ...] = ("doc_id", "piece"), by: str | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a column ``length`` (1..capacity).

    ``pieces`` is read twice, so it should be a written table. ``ties`` orders pieces of equal length. A sequence holds
    pieces of one value of the text column ``by`` only, if named; each value, null too, has a search of its own, so it
    should be a column of few values, such as a language.
    """
    spark = pieces.sparkSession
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    group = F.lit("") if by is None else F.coalesce(F.concat(F.lit("="), F.col(by)), F.lit(""))
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*ties), F.lit(buckets)).cast("int")).withColumn("_by", group)
    sizes = materialise(bucketed.groupBy("_by", "_bucket", "length").agg(F.count("*").alias("_n")), "packing-counts")
    counts: dict[str, dict[int, int]] = {}
    for value, length, n in sizes.groupBy("_by", "length").agg(F.sum("_n")).collect():
        counts.setdefault(value, {})[length] = n
    rows, begin = [], 0
    for value in sorted(counts):
        kinds = Search(counts[value], capacity).solve()
        rows += [(value, length, first, last, begin + sequence, *rest) for length, first, last, sequence, *rest in places(kinds)]
        begin += sum(n for n, _ in kinds)
    where = spark.createDataFrame(rows, "_of string, length bigint, _first bigint, _last bigint, _sequence bigint, _offset bigint, _each int")
    before = sizes.select(
        "_by",
        "_bucket",
        "length",
        (F.sum("_n").over(Window.partitionBy("_by", "length").orderBy("_bucket")) - F.col("_n")).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy("_by", "_bucket", "length").orderBy(*ties)) - 1
    ranked = bucketed.withColumn("_within", within).join(before, ["_by", "_bucket", "length"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_within"))
    placed = ranked.join(
        F.broadcast(where.withColumnRenamed("length", "_length")),
        (F.col("_by") == F.col("_of")) & (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), F.col("_last")),
    )
    step = F.col("_rank") - F.col("_first")
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(step / F.col("_each"))).cast("bigint").alias("sequence_id"),
        (F.col("_offset") + (step % F.col("_each")) * F.col("length")).cast("bigint").alias("offset"),
    )


def packed_documents(
    docs: DataFrame, file: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text", by: str | None = None
) -> DataFrame:
    """Pieces with their ids and their place: the token sequences to train on, each of one value of ``by``, if named."""
    return pack(materialise(cut_documents(docs, file, end_id, capacity, key, text, by), "pieces"), capacity, by=by)
