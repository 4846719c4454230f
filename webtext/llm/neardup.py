"""Near-duplicates of embeddings by Euclidean p-stable hashing.

Vectors are scaled to length 1, where a cosine of c is a distance of sqrt(2 - 2c). In each of
``tables`` tables a vector's bucket is given by ``projections`` random directions: its projections,
shifted and cut into steps of ``width``. Vectors that share a bucket are compared by their exact
cosine in double precision; a pair counts in the first table that brings it together. With the
default numbers a pair at cosine 0.98 meets with probability 0.998, at 0.985 with 0.9999, and
vectors at right angles share one bucket in 270,000.

Equal vectors are one node with a count. A bucket gives no pairs: each of its vectors gets its
number of links and its component within the bucket. A large bucket is cut into chunks by hash and
pairs of chunks are compared in tasks of their own, so no task holds more than two chunks.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows
without a label, have no links and are their own component; vectors of different length never link;
equal rows link with each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.graph import components
from webtext.llm.rows import binary_column
from webtext.llm.vectors import matrix, sorted_groups, usable
from webtext.llm.words import mix
from webtext.session import materialise


@dataclass(frozen=True)
class Hashing:
    tables: int = 26
    projections: int = 14
    width: float = 1.6
    seed: int = 7
    chunk: int = 512

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per vector and table; the tables' buckets never mix."""
        n, dims = vectors.shape
        draw = np.random.default_rng([self.seed, dims])
        directions = draw.standard_normal((dims, self.tables * self.projections))
        shifts = draw.uniform(0, self.width, self.tables * self.projections)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        steps = np.floor((unit @ directions + shifts) / self.width).astype(np.int64).astype(np.uint64).reshape(n, self.tables, self.projections)
        value = np.broadcast_to(mix(np.arange(self.tables, dtype=np.uint64) + np.uint64(dims << 16)), (n, self.tables))
        for i in range(self.projections):
            value = mix(value ^ steps[:, :, i])
        return value


def _by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, vectors)`` for each length of vector."""
    sizes = np.array([len(v) for v in column], np.int64)
    return [(rows, matrix(column.take(pa.array(rows)))) for size in np.unique(sizes) for rows in [np.flatnonzero(sizes == size)]]


def near_duplicates(table: DataFrame, least: float = 0.98, how: Hashing = Hashing(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row; only rows of equal label are compared."""
    rows = table.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    fit = usable("embedding") & F.col("label").isNotNull()
    named = rows.withColumn("node", F.when(fit, F.xxhash64("label", "embedding")))
    nodes = named.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    nodes = materialise(nodes, "neardup-nodes")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("salt", pa.int64()), ("buckets", pa.binary())])
        for batch in batches:
            for at, vectors in _by_length(batch.column("embedding")):
                chosen = batch.take(pa.array(at))
                value = how.buckets(vectors)
                salt = chosen.column("salt").to_numpy().astype(np.uint64)
                value = mix(value ^ mix(salt)[:, None])
                yield pa.RecordBatch.from_arrays(
                    [chosen.column("node"), chosen.column("salt"), binary_column(value, np.full(len(at), how.tables))], schema=schema
                )

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), np.int64)
            node = np.repeat(batch.column("node").to_numpy(), how.tables)
            number = np.tile(np.arange(how.tables, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(number), pa.array(node)], names=["bucket", "table_no", "node"])

    salted = nodes.select("node", F.xxhash64("label").alias("salt"), "embedding")
    keyed = materialise(salted.mapInArrow(hashed, "node bigint, salt bigint, buckets binary"), "neardup-buckets")
    entry = keyed.mapInArrow(entries, "bucket bigint, table_no int, node bigint")
    sizes = entry.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = materialise(sizes, "neardup-sizes")
    shared = entry.join(sizes, "bucket").withColumn("chunks", F.ceil(F.col("size") / how.chunk).cast("int"))
    shared = shared.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    spread = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    spread = spread.select(
        "bucket", "table_no", "node", "chunk", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second")
    )
    payload = nodes.select("node", "copies", "embedding").join(keyed.select("node", "buckets"), "node")
    full = spread.join(payload, "node")
    parts = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    dealt = full.repartition(parts, "bucket", "first", "second").sortWithinPartitions("bucket", "first", "second")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "bucket", "first", "second"):
            found = _links(group, least, how.tables)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "n", "root"])

    linked = materialise(dealt.mapInArrow(compare, "node bigint, n bigint, root bigint"), "neardup-links")
    counts = linked.groupBy("node").agg(F.sum("n").alias("n"))
    grouped = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    least_id = grouped.join(nodes.select("node", "vec_id"), "node").groupBy("component").agg(F.min("vec_id").alias("least"))
    named_groups = grouped.join(materialise(least_id, "neardup-least"), "component").select("node", "least")
    info = nodes.select("node", "vec_id", "copies").join(counts, "node", "left").join(named_groups, "node", "left")
    info = materialise(
        info.select(
            "node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id")
        ),
        "neardup-info",
    )
    with_links = named.filter("node IS NOT NULL").select("vec_id", "node").join(info, "node").select("vec_id", "n_links", "component_id")
    alone = named.filter("node IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return with_links.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(group: pa.Table, least: float, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Nodes of a bucket (or of two chunks) with links that no earlier table shows: number of links, smallest node of the component here."""
    order = np.argsort(group.column("node").to_numpy(), kind="stable")
    group = group.take(pa.array(order))
    node = group.column("node").to_numpy()
    vectors = matrix(group.column("embedding"))
    norms = np.linalg.norm(vectors, axis=1)
    near = (vectors @ vectors.T) / np.outer(norms, norms) >= least
    np.fill_diagonal(near, False)
    chunk = group.column("chunk").to_numpy()
    if group.column("first")[0].as_py() != group.column("second")[0].as_py():
        near &= chunk[:, None] != chunk[None, :]
    if not near.any():
        return None
    number = group.column("table_no")[0].as_py()
    buckets = np.frombuffer(b"".join(group.column("buckets").to_pylist()), np.int64).reshape(-1, tables)
    for t in range(number):
        near &= buckets[:, t, None] != buckets[None, :, t]
    has = near.any(axis=1)
    if not has.any():
        return None
    n = near @ group.column("copies").to_numpy()
    root = np.arange(len(node))
    while True:
        lowest = np.minimum(root, np.where(near, root[None, :], len(node)).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == root).all():
            break
        root = lowest
    return node[has], n[has].astype(np.int64), node[root[has]]
