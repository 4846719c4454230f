"""Token counts inside the row, and the join of tokens with a table keyed by token."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 128 * 1024 * 1024
SALTS = 8


def token_counts(df: DataFrame, key: str, tokens: Column, outer: bool = False) -> DataFrame:
    """Distinct tokens of each row with their count: ``(key, token, tf)``.

    Sorting the tokens inside the row puts equal ones together, so a token's count is the distance
    to where the next one starts. No shuffle and no aggregation over the token rows of the corpus.
    With ``outer`` a row without tokens gives one row with a NULL token.
    """
    ordered = df.select(key, F.sort_array(tokens).alias("_s"))
    starts = ordered.select(
        key,
        "_s",
        F.filter(
            F.transform("_s", lambda token, i: F.when(~token.eqNullSafe(F.get("_s", i - 1)), i)),
            lambda i: i.isNotNull(),
        ).alias("_at"),
    )
    runs = F.transform(
        "_at",
        lambda at, i: F.struct(
            F.get("_s", at).alias("token"),
            (F.coalesce(F.get("_at", i + 1), F.size("_s")) - at).alias("tf"),
        ),
    )
    # Always the outer form: for the plain one the optimizer tests for empty arrays first, and
    # that test computes everything above a second time.
    counts = starts.select(key, F.inline_outer(runs))
    return counts if outer else counts.filter(F.col("token").isNotNull())


def _width(field: T.StructField):
    """Bytes of one value."""
    column = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
        return F.coalesce(F.array_size(column), F.lit(0)) * 8 + 24
    if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
        return F.lit(8)
    return F.octet_length(F.to_json(F.struct(column)))


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the whole table, measured value by value, is within ``limit`` bytes."""
    per_row = reduce(lambda a, b: a + b, [_width(field) for field in table.schema.fields])
    measured = table.agg(F.sum(per_row.cast("long"))).first()[0]
    return (measured or 0) <= limit


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    spread_by: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join many token rows to a table with one row per key.

    The table is measured first. If it is small it is broadcast and the rows stay where they are.
    Otherwise both sides are shuffled, salted: rows of one token are spread over ``salts``
    partitions by ``spread_by`` and the table, which is far smaller, is repeated once per salt, so
    that a token holding a third of all rows is no single task; what is still uneven, adaptive
    skew-join handling splits further. Either way the result is the same.
    """
    if fits_broadcast(table, broadcast_bytes):
        return rows.join(F.broadcast(table), on, how)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    salted_table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_table, [*on, "_salt"], how).drop("_salt")
