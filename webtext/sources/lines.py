"""Line sources: one event per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def line_events(lines: DataFrame, tags: tuple[str, ...] = ()) -> DataFrame:
    """Text lines ``(value)`` to events ``(@timestamp, message, tags, date)``."""
    return lines.select(
        F.current_timestamp().alias("@timestamp"),
        F.col("value").alias("message"),
        F.array(*[F.lit(tag) for tag in tags]).cast("array<string>").alias("tags"),
    ).withColumn("date", F.to_date("@timestamp"))


def json_line_events(lines: DataFrame, schema: StructType, tags: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`line_events`, for JSON lines; the fields of ``schema`` become columns."""
    fields = F.from_json("message", schema)
    return line_events(lines, tags).withColumn("_fields", fields).select("*", "_fields.*").drop("_fields")


def read_lines(spark: SparkSession, path: str, tags: tuple[str, ...] = ()) -> DataFrame:
    return line_events(spark.read.text(path), tags)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").partitionBy("date").parquet(path)
