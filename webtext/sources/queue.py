"""A work queue as a folder: appended files are messages, a checkpoint remembers what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

MESSAGE = StructType([StructField("url", StringType())])


def publish(messages: DataFrame, queue: str) -> None:
    messages.write.mode("append").parquet(queue)


def consume(spark: SparkSession, queue: str, schema: StructType = MESSAGE, files_per_trigger: int = 1000) -> DataFrame:
    """Messages as a stream. A started query's checkpoint makes sure each file is taken once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(queue)
