"""Nearest neighbours by inner product with an inverted multi-index.

A vector's two halves are quantised separately, each by its own codebook of ``centroids`` centroids
(k-means on about ``sample`` vectors picked by hash), so a row lies in one of ``centroids**2`` cells.
For a query the pairs of centroids are taken from a heap in the order of their summed inner products
with the query's halves, until the cells taken hold ``share`` of all rows (at least ``least`` rows).
The rows of these cells are ranked again by the exact inner product in double precision.

Every row is indexed. Cells are gathered, in the order of their first centroid, into groups of about
``group`` rows; a larger cell is cut by hash. Queries come in blocks of ``block``; a task compares
one block with one group and keeps each query's best, so neither queries nor a full cell meet in one
task, and nothing but centroids and cell counts (both bounded by the codebook) is broadcast.

``share`` is the price of data without structure: for unclustered vectors the 20 nearest lie in
cells all over the index, and recall follows the share of rows looked at.

Defined results: vectors that are null, zero, or hold null or non-finite components, or are not as
long as most, and rows without an id, take no part, neither as query nor as candidate; a row is never its own neighbour, nor
is one with the same id; a query row that occurs several times with the same vector is one query, and rows
of one id with different vectors are queries of their own, each with its own ranks; repeated candidates
are rows of their own; ties go to the smaller id; fewer candidates than ``k`` are all returned; an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.vectors import matrix, sorted_groups, usable_vectors
from webtext.session import materialise


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """``k`` centroids, or as many as there are different points."""
    different = np.unique(points, axis=0)
    centroids = different[np.random.default_rng(seed).permutation(len(different))[:k]]
    for _ in range(rounds):
        near = nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1) - 2 * points @ centroids.T).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """Cells in the order of the largest ``first[i] + second[j]`` until they hold ``wanted`` rows.

    ``counts`` is the number of rows of each cell; only cells with rows are returned.
    """
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
    taken, held = [], 0
    # From (i, j) to (i, j + 1), and from (i, 0) also to (i + 1, 0): every pair enters the heap once.
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * len(second) + b[j]
        if counts[cell]:
            taken.append(cell)
            held += int(counts[cell])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))
    return np.array(taken, np.int64)


@dataclass(frozen=True)
class MultiIndex:
    centroids: int = 24
    sample: int = 4_096
    share: float = 0.6
    least: int = 2_000
    group: int = 4_096
    block: int = 16_384

    def search(self, table: DataFrame, chosen: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows of each row for which ``chosen`` holds."""
        spark = table.sparkSession
        rows = usable_vectors(table.withColumn("_query", F.coalesce(chosen, F.lit(False))), key, vector, "_query")
        rows = materialise(rows.filter("vec_id IS NOT NULL"), "ann-rows")
        schema = "query_id bigint, rank int, vec_id bigint, score double"
        sizes = {row[0]: row[1] for row in rows.groupBy(F.size("embedding")).count().collect()}
        if not sizes:
            return spark.createDataFrame([], schema)
        dims = max(sizes, key=lambda size: (sizes[size], -size))
        total = sizes[dims]
        rows = rows.filter(F.size("embedding") == dims)
        place = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_003))
        drawn = rows.filter(place < min(1.0, self.sample / total) * 1_000_003).select("embedding").limit(2 * self.sample).toPandas()["embedding"]
        points = np.array(drawn.tolist(), float) if len(drawn) else np.zeros((1, dims))
        half = max(1, dims // 2)
        books = [k_means(points[:, :half], self.centroids), k_means(points[:, half:], self.centroids) if dims > half else np.zeros((1, 0))]
        width = len(books[1])

        def place_in(vectors: np.ndarray) -> np.ndarray:
            return nearest(vectors[:, :half], books[0]) * width + (nearest(vectors[:, half:], books[1]) if dims > half else 0)

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = place_in(matrix(batch.column("embedding"))) if batch.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], names=[*batch.schema.names, "cell"])

        cells = materialise(rows.mapInArrow(index, "vec_id bigint, embedding array<double>, _query boolean, cell int"), "ann-index")
        counts = np.zeros(len(books[0]) * width, np.int64)
        for row in cells.groupBy("cell").count().collect():
            counts[row[0]] = row[1]
        first, parts = self._groups(counts)
        groups = int((first + parts).max())
        lookup = F.broadcast(spark.createDataFrame([(c, int(first[c]), int(parts[c])) for c in np.flatnonzero(counts).tolist()], "cell int, _first int, _parts int"))
        n_queries = cells.filter("_query").count()
        blocks = max(1, -(-n_queries // self.block))
        wanted = max(self.least, int(np.ceil(self.share * total)))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = matrix(batch.column("embedding"))
                a, b = vectors[:, :half] @ books[0].T, vectors[:, half:] @ books[1].T
                visited = [traverse(a[i], b[i], counts, wanted) for i in range(len(vectors))]
                flags, reached = [], []
                for found in visited:
                    flag = np.zeros(len(counts), bool)
                    flag[found] = True
                    flags.append(np.packbits(flag).tobytes())
                    hit = np.zeros(groups, bool)
                    for cell in found.tolist():
                        hit[first[cell] : first[cell] + parts[cell]] = True
                    reached.append(np.flatnonzero(hit).tolist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(flags, pa.binary()), pa.array(reached, pa.list_(pa.int32()))],
                    names=[*batch.schema.names, "cells", "groups"],
                )

        same = F.xxhash64(F.transform("embedding", lambda x: x + F.lit(0.0)))  # -0.0 as 0.0
        queries = cells.filter("_query").select("vec_id", "embedding", same.alias("query")).dropDuplicates(["vec_id", "query"])
        probed = queries.mapInArrow(probe, "vec_id bigint, embedding array<double>, query bigint, cells binary, groups array<int>")
        asked = probed.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.explode("groups").alias("grp"), F.lit(0).alias("side"),
            "vec_id", "embedding", "query", "cells", F.lit(-1).alias("cell"),
        )
        held = cells.join(lookup, "cell").select(
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
            (F.col("_first") + F.pmod(F.xxhash64("vec_id", F.lit(11)), F.col("_parts"))).cast("int").alias("grp"), F.lit(1).alias("side"),
            "vec_id", "embedding", F.lit(None).cast("bigint").alias("query"), F.lit(None).cast("binary").alias("cells"), "cell",
        )
        shuffles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
        dealt = asked.union(held).repartition(shuffles, "block", "grp").sortWithinPartitions("block", "grp", "side", "vec_id")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in sorted_groups(batches, "block", "grp"):
                found = _best(group, k, len(counts))
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "query", "vec_id", "score"])

        found = dealt.mapInArrow(compare, "query_id bigint, query bigint, vec_id bigint, score double")
        order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def _groups(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First group of each cell and number of groups it is cut into."""
        first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        group = held = 0
        for cell, n in enumerate(counts.tolist()):
            if n > self.group:
                group += 1 if held else 0
                parts[cell] = -(-n // self.group)
                first[cell] = group
                group, held = group + int(parts[cell]), 0
                continue
            if held + n > self.group:
                group, held = group + 1, 0
            first[cell] = group
            held += n
        return first, parts


#: Queries that are compared with a group's rows at once.
_TOGETHER = 512


def _best(group: pa.Table, k: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Each query's best ``k`` rows of one group among the rows of the cells it visits.

    A matrix product ranks first. Its sums run in an order that depends on a row's place, so all that lies within its rounding
    error of the k-th best is summed again component by component in one fixed order: equal vectors get equal scores.
    """
    side = group.column("side").to_numpy()
    n = int((side == 0).sum())
    if not n or n == len(side):
        return None
    vectors = matrix(group.column("embedding"))
    ids, rows = group.column("vec_id").to_numpy(), np.ascontiguousarray(vectors[n:])
    cell = group.column("cell").to_numpy()[n:]
    flags = np.frombuffer(b"".join(group.column("cells").slice(0, n).to_pylist()), np.uint8).reshape(n, -1)
    error = 4 * vectors.shape[1] * np.finfo(float).eps * np.sqrt((rows * rows).sum(axis=1)).max()
    queries, found, values = [], [], []
    for begin in range(0, n, _TOGETHER):
        own = vectors[begin : min(begin + _TOGETHER, n)]
        visits = np.unpackbits(flags[begin : begin + len(own)], axis=1, count=cells).view(bool)
        scores = own @ rows.T
        scores[~visits[:, cell]] = -np.inf
        scores[ids[begin : begin + len(own), None] == ids[None, n:]] = -np.inf
        least = np.partition(scores, -k, axis=1)[:, -k] if k < scores.shape[1] else np.full(len(own), -np.inf)
        near = (scores >= (least - error * np.sqrt((own * own).sum(axis=1)))[:, None]) & (scores > -np.inf)
        query, row = np.nonzero(near)
        value = (own[query] * rows[row]).sum(axis=1)
        order = np.lexsort((ids[n:][row], -value, query))
        query, row, value = query[order], row[order], value[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        queries.append(begin + query[rank < k])
        found.append(row[rank < k])
        values.append(value[rank < k])
    query, row = np.concatenate(queries), np.concatenate(found)
    return ids[:n][query], group.column("query").slice(0, n).to_numpy()[query], ids[n:][row], np.concatenate(values)
