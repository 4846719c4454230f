"""Confusion matrix, per-class report, ROC curve and area under it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webtext.session import materialise


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per pair of class and predicted class that occurs: ``(label, prediction, n)``."""
    return (
        df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    One pass over the rows makes the confusion counts; the rest works on those. A ratio with
    nothing below the line is 0.
    """
    pairs = confusion_matrix(df, label, prediction)
    sides = pairs.select(
        "n",
        F.inline(
            F.array(
                F.struct(
                    F.col("label").cast("string").alias("cls"),
                    F.lit(True).alias("actual"),
                    (F.col("label") == F.col("prediction")).alias("hit"),
                ),
                F.struct(
                    F.col("prediction").cast("string").alias("cls"),
                    F.lit(False).alias("actual"),
                    F.lit(False).alias("hit"),
                ),
            )
        ),
    )

    def ratio(above, below):
        return F.coalesce(F.try_divide(above, below), F.lit(0.0))

    per_class = sides.groupBy("cls").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("actual"), F.col("n")).otherwise(0)).alias("predicted"),
    )
    rated = per_class.select(
        "cls",
        "tp",
        "support",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )
    measures = ("precision", "recall", "f1")
    share = F.col("support") / F.sum("support").over(W.partitionBy("_all"))
    overall = (
        rated.withColumn("_all", F.lit(1))
        .withColumn("_share", share)
        .groupBy("_all")
        .agg(
            F.sum("support").alias("support"),
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            *[F.avg(m).alias(f"macro_{m}") for m in measures],
            *[F.sum(F.col(m) * F.col("_share")).alias(f"weighted_{m}") for m in measures],
        )
    )

    def summary(name, columns):
        return F.struct(
            F.lit(name).alias("cls"),
            *[F.col(c).alias(m) for c, m in zip(columns, measures)],
            F.col("support"),
        )

    summaries = overall.select(
        F.inline(
            F.array(
                summary("accuracy", ["accuracy"] * 3),
                summary("macro avg", [f"macro_{m}" for m in measures]),
                summary("weighted avg", [f"weighted_{m}" for m in measures]),
            )
        )
    )
    return rated.select("cls", *measures, "support").unionByName(summaries)


def running_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives at each score and above it, exact for any number of scores.

    Rows become counts per score first. Those are range-partitioned by falling score and written
    with their partition number; the totals of earlier partitions (one row per partition) are
    added to the running sum inside each partition. No window spans the whole data.
    """
    per_score = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    ranged = per_score.repartitionByRange(F.desc("score")).withColumn("_part", F.spark_partition_id())
    placed = materialise(ranged, "score-counts")
    # One row per partition: a few thousand at most, so one window and a broadcast are safe.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .select(
            "_part",
            F.coalesce(F.sum("pos").over(before), F.lit(0)).alias("_pos_before"),
            F.coalesce(F.sum("neg").over(before), F.lit(0)).alias("_neg_before"),
        )
    )
    within = W.partitionBy("_part").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    return placed.join(F.broadcast(offsets), "_part").select(
        "score",
        "pos",
        "neg",
        (F.col("_pos_before") + F.sum("pos").over(within)).alias("tp"),
        (F.col("_neg_before") + F.sum("neg").over(within)).alias("fp"),
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """True and false positive rate at each threshold, and the starting point above all scores."""
    points = running_counts(df, label, score)
    totals = points.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    curve = points.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), totals["n"]).alias("fpr"),
        F.try_divide(F.col("tp"), totals["p"]).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(start)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties count half; one row."""
    ranked = running_counts(df, label, score)
    ordered = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return ranked.agg(F.try_divide(ordered, F.sum("pos") * F.sum("neg")).alias("auc"))
