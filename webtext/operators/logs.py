"""Log lines to typed rows, routing by level, counts by day and hour."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.functions import logline


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add ``ts, level, thread, cls, line, msg`` to lines kept as ``raw``.

    The bars are found in one pass over the line. A line that does not fit the layout keeps
    ``raw`` and has NULL elsewhere. ``ts`` has no zone, like the line.
    """
    kept = [name for name in lines.columns if name != column]
    split = lines.select(
        *kept, F.col(column).alias("raw"), F.split(F.col(column), logline.FIELD_BAR, 5).alias("_f")
    )
    fields = split.select(
        *kept,
        "raw",
        F.get("_f", F.lit(0)).try_cast("timestamp_ntz").alias("_ts"),
        F.get("_f", F.lit(1)).alias("_level"),
        F.get("_f", F.lit(2)).alias("_thread"),
        F.get("_f", F.lit(3)).alias("_caller"),
        F.get("_f", F.lit(4)).alias("_msg"),
    )
    fits = (
        F.col("_ts").isNotNull()
        & F.col("raw").rlike(logline.DATE_HEAD)
        & F.col("_level").rlike(logline.LEVEL_NAME)
        & F.col("_caller").rlike(logline.CALLER)
        & F.col("_msg").isNotNull()
    )
    return fields.select(
        *kept,
        "raw",
        F.when(fits, F.col("_ts")).alias("ts"),
        F.when(fits, F.col("_level")).alias("level"),
        F.when(fits, F.col("_thread")).alias("thread"),
        F.when(fits, F.rtrim(F.regexp_extract("_caller", logline.CALLER, 1))).alias("cls"),
        F.when(fits, F.regexp_extract("_caller", logline.CALLER, 2)).try_cast("int").alias("line"),
        F.when(fits, F.col("_msg")).alias("msg"),
    )


def route_levels(lines: DataFrame, level: str = "level") -> DataFrame:
    """One row per line and sink that accepts its level; none for a line no sink takes.

    The four sinks are literals, so the range match runs inside the row: no join, no shuffle.
    """
    return lines.withColumn("sink", F.explode_outer(logline.accepting_sinks(F.col(level)))).filter(
        F.col("sink").isNotNull()
    )


def with_day(lines: DataFrame, ts: str = "ts") -> DataFrame:
    return lines.withColumn("day", F.to_date(ts))


def write_routed(lines: DataFrame, path: str, ts: str = "ts") -> None:
    """Append routed lines, one folder per sink and day.

    Lines of a sink and day meet in a few tasks (by minute of the hour, modulo 8), so a day has a few files.
    """
    dealt = with_day(lines, ts).repartition("sink", "day", F.pmod(F.minute(ts), F.lit(8)))
    dealt.write.mode("append").partitionBy("sink", "day").parquet(path)


def daily_counts(routed: DataFrame, ts: str = "ts") -> DataFrame:
    return with_day(routed, ts).groupBy("sink", "day").agg(F.count("*").alias("lines"))


def daily_sink_counts(lines: DataFrame, level: str = "level", ts: str = "ts") -> DataFrame:
    """Lines per sink and day; counted by level and day first, so only a handful of rows goes to the sinks."""
    levels = with_day(lines, ts).groupBy(level, "day").agg(F.count("*").alias("lines"))
    return route_levels(levels, level).groupBy("sink", "day").agg(F.sum("lines").alias("lines"))


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """Lines that :func:`write_routed` wrote; ``sink`` and ``day`` come from the folders."""
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))


def time_buckets(
    events: DataFrame,
    ts: str = "ts",
    start: Column | None = None,
    end: Column | None = None,
    width: str = "1 hour",
) -> DataFrame:
    """Events per time bucket, ``start <= ts < end`` where given."""
    bounds = [F.col(ts) >= start] if start is not None else []
    bounds += [F.col(ts) < end] if end is not None else []
    kept = events.filter(reduce(lambda a, b: a & b, bounds)) if bounds else events
    return (
        kept.groupBy(F.window(ts, width).alias("_w"))
        .agg(F.count("*").alias("events"))
        .select(F.col("_w.start").alias("bucket"), "events")
    )


def topic_pattern(pattern: str) -> str:
    """Topic pattern to a regular expression: ``*`` is one word, ``#`` is any number of words.

    A ``#`` for no words takes its dot along: ``a.#`` matches ``a``.
    """
    expression = ""
    words = pattern.split(".")
    for position, word in enumerate(words):
        dot = r"\." if position else ""
        if word == "#":
            if len(words) == 1:
                return "^.*$"
            expression += r"(?:[^.]+\.)*" if not position else rf"(?:{dot}[^.]+)*"
        else:
            if position == 1 and words[0] == "#":
                dot = ""
            expression += dot + ("[^.]+" if word == "*" else rf"\Q{word}\E")
    return f"^{expression}$"


def route_key(messages: DataFrame, key: str, column: str = "routing_key") -> DataFrame:
    """Direct routing: messages whose key is exactly ``key``."""
    return messages.filter(F.col(column) == key)


def route_topic(messages: DataFrame, pattern: str, column: str = "exchange") -> DataFrame:
    """Topic routing: messages whose source name fits the pattern; the name stays a column."""
    return messages.filter(F.col(column).rlike(topic_pattern(pattern)))
