"""Connected components of a table of links, all in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its smallest node.

    Each round a node takes the smallest label of its neighbours and then the label of that label,
    so labels cross long chains in few rounds. A round is written, which cuts the lineage; the end
    is a round that changes nothing. Only counts reach the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = materialise(both.distinct(), "links")
    labels = materialise(
        both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels"
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("least"))
        taken = near.withColumnRenamed("a", "node").join(labels, "node").select("node", "component", F.least("component", "least").alias("_next"))
        up = labels.select(F.col("node").alias("_next"), F.col("component").alias("_up"))
        stepped = taken.join(up, "_next").select("node", F.least("_next", "_up").alias("component"), (F.col("component") != F.least("_next", "_up")).alias("changed"))
        stepped = materialise(stepped, "labels")
        labels = stepped.select("node", "component")
        if stepped.filter("changed").isEmpty():
            return labels
