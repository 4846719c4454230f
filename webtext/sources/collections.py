"""Collections of documents: create, append, export, scan several at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from webtext.operators.extract import ARTICLE_FIELDS
from webtext.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for CPU-heavy work: a small one is spread over the cores."""
    return spread(table(spark, folder, name), f"{folder}/{name}.parquet")


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Pages that were fetched; a failed fetch has no ``html``."""
    return pages.filter(F.col("html").isNotNull())


def source_json(*columns: str) -> Column:
    """A document as JSON text; missing values are left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})


def article_documents(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Article records as JSON documents."""
    return records.select(*keys, source_json("url", "title", "dateTime", "author", "content").alias("_source"))


def create_collection(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """Create a table unless it is there. Shards are a matter of :func:`append`."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet{location}")


def append(records: DataFrame, path: str, shards: int | None = None) -> None:
    """Append records, never an upsert. ``shards`` sets the number of files; the default is no shuffle."""
    (records if shards is None else records.repartition(shards)).write.mode("append").parquet(path)


def append_articles(records: DataFrame, path: str, shards: int | None = None) -> None:
    append(records.select(*ARTICLE_FIELDS), path, shards)


def scan_all(collections: Mapping[str, DataFrame], prefix: str = "") -> DataFrame:
    """All collections whose name has the prefix, as one; ``_index`` keeps the name."""
    chosen = [df.withColumn("_index", F.lit(name)) for name, df in collections.items() if name.startswith(prefix)]
    if not chosen:
        raise ValueError(f"no collection has the prefix {prefix!r}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chosen)


#: Kinds of types; a field that has several kinds becomes text.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def widest(types: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type that holds all: numbers and times widen in their order, anything else becomes text."""
    distinct = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(distinct) <= 1:
        return distinct[0] if distinct else T.StringType()
    for ladder in (_NUMBERS, _TIMES):
        if all(isinstance(t, ladder) for t in distinct):
            return max(distinct, key=lambda t: ladder.index(type(t)))
    return T.StringType()


def _as_text(column: Column, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(column) if nested else column.cast("string")


def scan_typed(
    collections: Mapping[str, DataFrame],
    prefix: str = "",
    declared: Mapping[str, T.DataType] | None = None,
    rescued: str = "_rescued",
) -> DataFrame:
    """Like :func:`scan_all` for collections whose fields differ in type.

    A field gets its type in ``declared``, else the widest of its types. A value that does not come
    through unchanged, such as text that is no number or a long number as a double, is NULL in the
    field and kept as text in the map ``rescued``, which is NULL where all values fit.
    """
    chosen = {name: df for name, df in collections.items() if name.startswith(prefix)}
    if not chosen:
        raise ValueError(f"no collection has the prefix {prefix!r}")
    seen: dict[str, list[T.DataType]] = {}
    for df in chosen.values():
        for field in df.schema.fields:
            seen.setdefault(field.name, []).append(field.dataType)
    wanted = {name: (declared or {}).get(name) or widest(types) for name, types in seen.items()}

    def typed(df: DataFrame) -> DataFrame:
        values, losses = [], []
        for field in df.schema.fields:
            column, target = F.col(f"`{field.name}`"), wanted[field.name]
            if field.dataType == target:
                values.append(column)
                continue
            if isinstance(target, T.StringType):
                values.append(_as_text(column, field.dataType).alias(field.name))
                continue
            cast = column.try_cast(target)
            fits = cast.isNotNull()
            if not isinstance(field.dataType, T.StringType):
                fits = fits & cast.try_cast(field.dataType).eqNullSafe(column)
            values.append(F.when(fits, cast).alias(field.name))
            text = _as_text(column, field.dataType)
            losses.append(F.when(column.isNotNull() & ~fits, F.struct(F.lit(field.name).alias("key"), text.alias("value"))))
        lost = F.array_compact(F.array(*losses)) if losses else None
        kept = F.lit(None) if lost is None else F.when(F.size(lost) > 0, F.map_from_entries(lost))
        return df.select(*values, kept.cast("map<string,string>").alias(rescued))

    return scan_all({name: typed(df) for name, df in chosen.items()})


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(records: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Append records to folders by a hash of their key, sorted by key within a file."""
    dealt = records.withColumn("bucket", _bucket(key, buckets)).repartition("bucket").sortWithinPartitions("bucket", key)
    dealt.write.mode("append").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, wanted: DataFrame, key: str, buckets: int = 64) -> DataFrame:
    """The records of the buckets that keys of ``wanted`` fall in; other folders are not read.

    At most ``buckets`` numbers reach the driver.
    """
    numbers = [row[0] for row in wanted.select(_bucket(key, buckets)).distinct().collect()]
    return spark.read.parquet(path).filter(F.col("bucket").isin(numbers)).drop("bucket")


def create_sharded(records: DataFrame, name: str, key: str, shards: int, path: str | None = None) -> None:
    """Create a table with the records, unless it is there: ``shards`` buckets by key, each sorted by it.

    Joins and aggregations by the key of such tables with equal ``shards`` need no exchange.
    """
    spark = records.sparkSession
    if not spark.catalog.tableExists(name):
        _sharded(records, key, shards, path).mode("ignore").saveAsTable(name)


def append_sharded(records: DataFrame, name: str, key: str, shards: int) -> None:
    """Append records to a table of :func:`create_sharded`, never an upsert."""
    _sharded(records, key, shards).mode("append").saveAsTable(name)


def _sharded(records: DataFrame, key: str, shards: int, path: str | None = None):
    writer = records.repartition(shards, key).write.format("parquet").bucketBy(shards, key).sortBy(key)
    return writer.option("path", path) if path else writer
