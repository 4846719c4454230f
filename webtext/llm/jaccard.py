"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct five-word shingles (as 64-bit hashes; a shorter document is
one shingle). The parity sketch of a set flips one bit per shingle, so the sketches of two sets
differ in at most as many bits as the sets have elements that are not shared. Sets of sizes a and b
with similarity s or more differ in at most ``(a + b) * (1 - s) / (1 + s)`` elements. The sketch is cut
into segments; a segment is kept as the XOR of its bits' 64-bit codes, so no bits are stored and
equal segments have equal codes. If at most d segments differ, two sketches agree in a segment
among the first d + 1 non-empty ones of either, in any order of segments that is the same for all.
So each document gives d + 1 keys per size band, and documents that share a key are compared.

The order puts segments of very frequent shingles last, so a passage that many documents share
makes no keys where a document has enough of its own. Equal sets are one node. Documents of a key
are first compared with the most central node of the key only, and what that links is put into
components. Then nodes of one key in different components are compared by narrow sketches within
tasks; each node's nearest is verified by the full sets, components grow, and last every pair left
that shares a key, lies in different components and has near enough sketches is verified. So no
link between components is lost, and groups of many copies do not give all their pairs.

Defined results: null text, empty text and text without words have no shingle and link with
nothing; equal rows are equal sets; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.graph import components
from webtext.llm.rows import binary_column, slices, texts_of, tidy, worker_caches
from webtext.llm.vectors import sorted_groups
from webtext.llm.words import mix, word_hashes
from webtext.operators.lookup import fits_broadcast
from webtext.session import materialise

WIDTH = 5
SIMILARITY = Fraction(4, 5)
#: A shingle this frequent within one task is counted for the order of segments; the most frequent are put last.
LOCAL, MANY, LISTED = 4, 24, 1_000_000
#: Groups of a key up to this size give their pairs by a join; larger ones are compared in chunks of so many nodes.
SMALL, CHUNK = 8, 256
_BUFFER = 2_000_000

_FACTORS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64)) | np.uint64(1)


def _ascending(values: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingles(texts: list[str]) -> list[np.ndarray]:
    """The set of each text: ascending distinct 64-bit hashes."""
    parts = [text.encode("utf-8", "surrogatepass") for text in texts]
    begins, hashes = word_hashes(b"\n".join(parts))
    places = np.cumsum([0, *(len(part) + 1 for part in parts)])
    bounds = np.searchsorted(begins, places)
    total = np.zeros(max(0, len(hashes) - WIDTH + 1), np.uint64)
    for i in range(WIDTH if len(total) else 0):
        total += hashes[i : i + len(total)] * _FACTORS[i]
    total = mix(total)
    result = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = end - begin
        if n >= WIDTH:
            result.append(_ascending(total[begin : end - WIDTH + 1]))
        elif n:
            whole = (hashes[begin:end] * _FACTORS[:n]).sum(dtype=np.uint64) + np.uint64(n)
            result.append(mix(np.array([whole], np.uint64)))
        else:
            result.append(np.zeros(0, np.uint64))
    return result


def fingerprints(sets: list[np.ndarray]) -> list[int | None]:
    """A signed 64-bit number of each set, None for an empty one."""
    held = [found for found in sets if len(found)]
    if not held:
        return [None] * len(sets)
    flat = mix(np.concatenate(held))
    begins = np.cumsum([0, *(len(found) for found in held[:-1])])
    value = mix(mix(np.add.reduceat(flat, begins)) + mix(np.bitwise_xor.reduceat(flat, begins)))
    found = iter(value.view(np.int64).tolist())
    return [next(found) if len(one) else None for one in sets]


def sketch(found: np.ndarray) -> bytes:
    """The parity of the shingles of each bit; two bits a shingle, rounded up to a power of 2."""
    bits = 1 << max(6, (2 * len(found) - 1).bit_length())
    return np.packbits(np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Different bits of two sketches; the wider one is folded to the width of the other, which keeps it a parity sketch."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum())


def most_different(a: int, b: int, similarity: Fraction = SIMILARITY) -> int:
    """How many elements may be in only one of two sets of these sizes."""
    return (a + b) * (similarity.denominator - similarity.numerator) // (similarity.denominator + similarity.numerator)


def bands(n: int, similarity: Fraction = SIMILARITY) -> list[tuple[int, int]]:
    """``(band, largest partner)``: the band of the size, and the next one if a partner may lie there."""
    own = n.bit_length()
    largest = n * similarity.denominator // similarity.numerator
    found = [(own, min(largest, (1 << own) - 1))]
    if largest >= 1 << own:
        found.append((own + 1, largest))
    return found


def keys(found: np.ndarray, last: np.ndarray, similarity: Fraction = SIMILARITY) -> np.ndarray:
    """Keys of a set; ``last`` marks the shingles whose segments come last."""
    result = []
    for band, partner in bands(len(found), similarity):
        need = most_different(len(found), partner, similarity) + 1
        segments = np.uint64(1 << (band - 1) if band > 6 else 1 << 31)
        segment = ((found >> np.uint64(32)) * segments >> np.uint64(32)) + last * segments
        if last.any():
            order = np.argsort(segment, kind="stable")
            segment, codes = segment[order], mix(found[order])
        else:
            codes = mix(found)
        begins = np.flatnonzero(np.diff(segment, prepend=np.uint64(1 << 63)))
        if len(begins) < need:
            raise ValueError("shingle hashes are not spread over the segments")
        parity = np.bitwise_xor.reduceat(codes, begins)[:need]
        result.append(mix(parity ^ mix(segment[begins[:need]] + np.uint64(band << 40))))
    return np.concatenate(result)


class Join:
    """Documents, equal-set nodes and links of one table."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text"):
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        read = materialise(self.docs.mapInArrow(_survey, "doc_id bigint, n bigint, node bigint, sketch binary, frequent bigint"), "jaccard-survey")
        self.rows = read.filter("frequent IS NULL").select("doc_id", "n", "node")
        self.frequent = read.filter("frequent IS NOT NULL").groupBy("frequent").agg(F.sum("n").alias("n")).filter(F.col("n") >= MANY)
        self.nodes = materialise(
            read.filter("n > 0 AND frequent IS NULL")
            .groupBy("node")
            .agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.max("sketch").alias("sketch")),
            "jaccard-nodes",
        )

    def members(self) -> DataFrame:
        """``(key, node, size, leader)`` of the keys that at least two nodes share.

        The leader is the node of the key whose keys have the most nodes in all: of a text and its edited
        copies that is the text, as an edit takes a copy out of the groups of the keys it touches.
        """
        rows = self.frequent.orderBy(F.desc("n"), "frequent").limit(LISTED).select("frequent").toPandas()
        listed = self.spark.sparkContext.broadcast(np.sort(rows["frequent"].to_numpy(np.int64).view(np.uint64)))

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hot, done = listed.value, set()
            for part in slices(batches, "text"):
                nodes, sets = [], []
                made = shingles(texts_of(part))
                for node, found in zip(fingerprints(made), made):
                    if node is not None and node not in done:  # equal sets of a task give their keys once
                        done.add(node)
                        nodes.append(node)
                        sets.append(found)
                if not nodes:
                    continue
                flat = np.concatenate(sets)
                last = np.zeros(len(flat), bool)
                if len(hot):
                    last = hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] == flat
                marks = np.split(last, np.cumsum([len(s) for s in sets])[:-1])
                own = [keys(found, mark) for found, mark in zip(sets, marks)]
                sizes = [len(k) for k in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(own).astype(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), sizes))], names=["key", "node"]
                )

        rows = self.docs.mapInArrow(emit, "key bigint, node bigint")
        same = Window.partitionBy("key")
        marked = rows.select(
            "key", "node", F.min("node").over(same).alias("low"), F.max("node").over(same).alias("high"), F.count("*").over(same).alias("size")
        )
        shared = materialise(marked.filter("low < high").select("key", "node", "size"), "jaccard-shared")
        central = materialise(shared.groupBy("node").agg(F.sum("size").alias("central")), "jaccard-central")
        best = F.max(F.struct("central", "node")).over(same)["node"].alias("leader")
        return materialise(shared.join(central, "node").select("key", "node", "size", best), "jaccard-members")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """``(a, b, linked)`` of candidate pairs of nodes that sizes and sketches leave, by their whole sets."""
        known = self.nodes.select("node", "n", "sketch")
        sized = pairs.join(known.toDF("a", "na", "sa"), "a").join(known.toDF("b", "nb", "sb"), "b")
        over, under = SIMILARITY.denominator, SIMILARITY.numerator
        sized = sized.filter(F.least("na", "nb") * over >= F.greatest("na", "nb") * under)
        pairs = materialise(sized.mapInArrow(_near, "a bigint, b bigint"), "jaccard-pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = materialise(wanted.join(self.nodes.select("node", "doc_id"), "node"), "jaccard-wanted")
        wanted = F.broadcast(wanted) if fits_broadcast(wanted, 32 << 20) else wanted
        sets = materialise(self.docs.join(wanted, "doc_id").select("node", "text").mapInArrow(_sets, "node bigint, found binary"), "jaccard-sets")
        sets = sets.dropDuplicates(["node"])
        both = pairs.join(sets.toDF("a", "found_a"), "a").join(sets.toDF("b", "found_b"), "b")
        return materialise(both.mapInArrow(_compare, "a bigint, b bigint, linked boolean"), "jaccard-verified")

    def groups(self) -> DataFrame:
        """``(node, component)`` of nodes with a link."""
        members = self.members()
        stars = members.filter("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        checked = self.verified(stars.distinct())
        grouped = components(checked.filter("linked").select("a", "b"))
        for nearest in (True, False):
            pairs = self.apart(members, grouped, nearest)
            more = self.verified(pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti"))
            checked = materialise(checked.union(more), "jaccard-checked")
            if not more.filter("linked").isEmpty():
                grouped = components(checked.filter("linked").select("a", "b"))
        return grouped

    def apart(self, members: DataFrame, grouped: DataFrame, nearest: bool) -> DataFrame:
        """Pairs ``(a, b)`` of nodes that share a key, lie in different components and may be similar by their sketches.

        With ``nearest`` only the best partner of each node in the large groups of a key; else all pairs.
        A small group gives its few pairs by a join. A large one is compared by sketches within tasks, in
        pairs of chunks, and only pairs whose sketches are near enough leave the task.
        """
        same = Window.partitionBy("key")
        placed = members.join(grouped, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        placed = placed.distinct().select(
            "*", F.min("component").over(same).alias("_low"), F.max("component").over(same).alias("_high"), F.count("*").over(same).alias("size")
        )
        placed = materialise(placed.filter("_low < _high").select("key", "node", "component", "size"), "jaccard-apart")
        large = placed.filter(F.col("size") > SMALL).withColumn("chunks", F.ceil(F.col("size") / CHUNK).cast("int"))
        large = large.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        large = large.join(self.nodes.select("node", "n", "sketch"), "node").select(
            "key", "node", "component", "n", "sketch", "chunk", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second")
        )
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 8)
        dealt = large.repartition(parts, "key", "first", "second").sortWithinPartitions("key", "first", "second")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in sorted_groups(batches, "key", "first", "second"):
                a, b = _within(group, nearest)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        pairs = dealt.mapInArrow(compare, "a bigint, b bigint")
        if not nearest:
            small = placed.filter(F.col("size") <= SMALL).select("key", "node", "component")
            left, right = small.toDF("key", "a", "_ca"), small.toDF("key", "b", "_cb")
            pairs = pairs.union(left.join(right, "key").filter("a < b AND _ca <> _cb").select("a", "b"))
        return pairs.distinct()

    def result(self) -> DataFrame:
        """``(doc_id, n_shingles, component_id)``: one row per document, the component by its smallest doc_id."""
        grouped = self.groups()
        least = grouped.join(self.nodes, "node").groupBy("component").agg(F.min("doc_id").alias("least"))
        named = grouped.join(materialise(least, "jaccard-least"), "component").select("node", "least")
        named = materialise(
            self.nodes.join(named, "node", "left").select("node", F.coalesce("least", "doc_id").alias("component_id")), "jaccard-components"
        )
        filled = self.rows.filter("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        empty = self.rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        return filled.union(empty)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, n, node, null)`` of documents, ``(null, n, null, shingle)`` of shingles frequent within the task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sketch", pa.binary()), ("frequent", pa.int64())])
    worker_caches.clear()
    tidy()
    buffer: list[np.ndarray] = []
    done: set[int] = set()
    held = 0

    def frequent() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(buffer), return_counts=True)
        keep = counts >= LOCAL
        n = int(keep.sum())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.array(counts[keep].astype(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(values[keep].view(np.int64))],
            schema=schema,
        )

    for part in slices(batches, "text"):
        sets = shingles(texts_of(part))
        nodes = fingerprints(sets)
        for node, found in zip(nodes, sets):
            if node is not None and node not in done:
                done.add(node)
                buffer.append(found)
                held += len(found)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(nodes, pa.int64()),
                pa.array([sketch(s) for s in sets], pa.binary()),
                pa.nulls(len(sets), pa.int64()),
            ],
            schema=schema,
        )
        if held >= _BUFFER:
            yield frequent()
            buffer, held = [], 0
    if buffer:
        yield frequent()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        sets = shingles(texts_of(part))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([part.column("node"), binary_column(flat, np.array([len(s) for s in sets]))], names=["node", "found"])


def _within(group: pa.Table, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group's nodes in different components whose sketches allow a link."""
    node, component, n, chunk = (group.column(name).to_numpy() for name in ("node", "component", "n", "chunk"))
    raw = [np.frombuffer(x, np.uint64) for x in group.column("sketch").to_pylist()]
    width = min(map(len, raw))
    bits = np.stack([np.bitwise_xor.reduce(x.reshape(-1, width), axis=0) for x in raw])
    across = group.column("first")[0].as_py() != group.column("second")[0].as_py()
    least, most = SIMILARITY.denominator - SIMILARITY.numerator, SIMILARITY.denominator + SIMILARITY.numerator
    left, right = [], []
    for i in range(len(node)):
        open_ = component != component[i]
        if across:
            open_ &= chunk != chunk[i]
        if not nearest:
            open_ &= node > node[i]
        at = np.flatnonzero(open_)
        if not len(at):
            continue
        different = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
        fits = different <= (n[at] + n[i]) * least // most
        if not fits.any():
            continue
        at = at[[np.where(fits, different, 1 << 40).argmin()]] if nearest else at[fits]
        left.append(np.minimum(node[i], node[at]))
        right.append(np.maximum(node[i], node[at]))
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(name).to_pylist() for name in ("na", "nb", "sa", "sb")))
        keep = [distance(sa, sb) <= most_different(na, nb) for na, nb, sa, sb in rows]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for a, b in zip(batch.column("found_a"), batch.column("found_b")):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(shared * SIMILARITY.denominator >= (len(x) + len(y) - shared) * SIMILARITY.numerator)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``."""
    return Join(docs, key, text).result()


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that have the smallest key of their component.

    Of equal rows one stays. Rows without a word stay, and so do rows without a key.
    """
    found = materialise(join(docs, key, text), "jaccard-result")
    gone = materialise(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "jaccard-gone")
    again = materialise(
        found.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_again")).count().filter("count > 1").select("_again"), "jaccard-again"
    )

    def of(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if fits_broadcast(table, 32 << 20) else table

    left = docs.join(of(gone), F.col(key).cast("bigint") == F.col("_gone"), "left_anti")
    if again.isEmpty():
        return left
    once = left.join(of(again), F.col(key).cast("bigint") == F.col("_again"), "left_anti")
    repeated = left.join(of(again), F.col(key).cast("bigint") == F.col("_again"), "left_semi")
    return once.unionByName(repeated.dropDuplicates([key, text]))
