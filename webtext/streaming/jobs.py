"""The crawl's stages as streams: discover links, parse pages, ingest lines.

Every job is a plain projection or a join with a static table, so there is no state to grow.
The checkpoint takes the place of an acknowledgement: a file counts as done once its batch is
committed, and the file sink commits each batch once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from webtext.operators import extract
from webtext.sources import lines

PAGE = StructType(
    [
        StructField("page_id", LongType()),
        StructField("url", StringType()),
        StructField("html", StringType()),
    ]
)


def read_pages(
    spark: SparkSession, folder: str, schema: StructType = PAGE, pattern: str = "*.parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """Fetched pages as a stream of files below ``folder`` whose names fit the pattern."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType = PAGE, files_per_trigger: int = 1000) -> DataFrame:
    """The table ``name`` of a folder as a stream, be it one file or a folder of part files."""
    path = f"{folder}/{name}.parquet"
    status = spark.read.format("binaryFile").option("pathGlobFilter", f"{name}.parquet").load(folder).select("path")
    if status.isEmpty():
        return read_pages(spark, path, schema, "*.parquet", files_per_trigger)
    return read_pages(spark, folder, schema, f"{name}.parquet", files_per_trigger)


def read_lines(
    spark: SparkSession, folder: str, tags: tuple[str, ...] = (), files_per_trigger: int = 1000
) -> DataFrame:
    """Text files as a stream of line events."""
    return lines.line_events(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder), tags)


def start(
    stream: DataFrame, output: str, checkpoint: str, partition_by: tuple[str, ...] = (), once: bool = True
) -> StreamingQuery:
    """Append a stream to a folder. ``once`` takes what is there and stops; otherwise it runs on."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def run_once(stream: DataFrame, output: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Process all waiting input and return; an error in the stream is raised here."""
    start(stream, output, checkpoint, partition_by).awaitTermination()


def discover_links(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Pages to link messages, one page to many."""
    return extract.links(pages, keys)


def discover_cards(
    pages: DataFrame, profile: extract.TreeProfile = extract.NEWS_SITE, site: Column | None = None
) -> DataFrame:
    """Listing pages to link messages ``(url)``, one per readable card."""
    found = extract.cards(pages, profile, site=site)
    return found.filter(F.col("link").isNotNull()).select(F.col("link").alias("url"))


def parse_pages(
    pages: DataFrame,
    profile: extract.PatternProfile | extract.TreeProfile = extract.PLAIN_PAGES,
    on_error: str = "keep",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Fetched pages to article records."""
    return extract.articles(pages, profile, on_error, keys)
