"""Profile of labelled text: counts, missing values, means and histograms per class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

BINS = 10


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass; NaN is missing too."""

    def missing(field):
        column = F.col(field.name)
        floating = isinstance(field.dataType, (FloatType, DoubleType))
        return F.count_if(column.isNull() | F.isnan(column) if floating else column.isNull()).alias(field.name)

    counted = df.agg(*[missing(field) for field in df.schema.fields])
    return counted.unpivot([], df.columns, "column", "nulls")


def mean_by(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Mean per class; missing values are skipped, rows without a class are left out."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias(name))


def histogram_by(df: DataFrame, by: str, value: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins from the least to the greatest value of each class.

    The last bin is closed. A class with one distinct value gets a range of 0.5 to either side.
    Rows are reduced to counts of distinct values first; the bounds come from those counts, and
    because they ask for ``n`` too, both sides of the join share one shuffle. Missing values count
    nothing and go at the end: a filter on ``value`` in front would compute it twice.
    """
    number = F.col(value).cast("double")
    counts = df.filter(F.col(by).isNotNull()).groupBy(by, number.alias("v")).agg(F.count(number).alias("n"))
    bounds = (
        counts.groupBy(by)
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("_rows"))
        .filter(F.col("_rows") > 0)
    )
    flat = F.col("lo") == F.col("hi")
    low = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    binned = F.least(F.floor((F.col("v") - low) * bins / width), F.lit(bins - 1)).cast("int")
    return (
        counts.join(bounds, by)
        .groupBy(by, binned.alias("bin"))
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > 0)
    )


def head(df: DataFrame, key: str, size: int = 5) -> DataFrame:
    """First rows by key."""
    return df.orderBy(key).limit(size)
