"""Age-based retention of collections."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def retention_plan(catalogue: DataFrame, now: datetime, prefix: str = "logstash-", days: int = 2) -> DataFrame:
    """Collections ``(name, creation_date)`` to drop: right prefix and strictly older than ``days``."""
    kind = catalogue.schema["creation_date"].dataType
    # As text, so that no zone conversion takes place on the way.
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz" if isinstance(kind, TimestampNTZType) else "timestamp")
    oldest_kept = moment - F.make_dt_interval(F.lit(days))
    return catalogue.filter(F.col("name").startswith(prefix) & (F.col("creation_date") < oldest_kept))


def apply_retention(spark: SparkSession, plan: DataFrame, apply: bool = False) -> list[str]:
    """Names in the plan; with ``apply`` the tables of those names are dropped.

    Only catalogue entries pass through here, never rows. An empty plan is fine.
    """
    names = [row["name"] for row in plan.select("name").toLocalIterator()]
    if apply:
        for name in names:
            quoted = "`" + name.replace("`", "``") + "`"
            spark.sql(f"DROP TABLE IF EXISTS {quoted}")
    return names
