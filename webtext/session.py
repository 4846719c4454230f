"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def build_session(app: str = "webtext", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Web pages are wide rows: small Arrow batches keep Python workers small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where a local master names none (tests, a laptop), one temporary folder per application takes
    its place. On a cluster a machine's own folder would lose data, so a missing name is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="webtext-")
    return _own_dirs[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/webtext/{name}-{uuid.uuid4().hex}"


#: Shuffle files go when their job ends. Else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used for fitted tables that are read several times. The files survive the
    loss of executors, the lineage is cut, and Spark knows the real size. What the job shuffled is removed.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_to = path
    return written


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that begin in here remove their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables from :func:`materialise` that nothing will read again; other tables are left alone."""
    for table in tables:
        if path := getattr(table, "_written_to", None):
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Bytes of files that a task of CPU-heavy work gets at most.
TASK_BYTES = 16 << 20


def spread(df: DataFrame, path: str) -> DataFrame:
    """Deal rows of a file scan out before CPU-heavy column work, where its own tasks are few or large.

    A scan whose files, all in all, are within ``spark.sql.files.maxPartitionBytes`` gets one partition per core. Of
    larger ones only those with a file of more than ``TASK_BYTES`` are dealt out, that much to a partition: a row group
    is read by one task however large it is. Any other scan is returned as it is.
    """
    spark = df.sparkSession
    limit = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    held, longest = files.agg(F.sum("length"), F.max("length")).first()
    cores = spark.sparkContext.defaultParallelism
    if (held or 0) <= limit:
        return df.repartition(cores)
    return df.repartition(max(cores, -(-held // TASK_BYTES))) if longest > TASK_BYTES else df


def _bytes(size: str) -> int:
    """A size as Spark writes it: ``134217728b``, ``16m``, ``1g`` or a plain number."""
    units = {"b": 0, "k": 10, "m": 20, "g": 30, "t": 40}
    text = size.strip().lower().removesuffix("b") or "0"
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)
