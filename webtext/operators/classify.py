"""Classifiers on the features: multinomial naive Bayes from counts, logistic regression."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.operators.lookup import lookup, token_counts
from webtext.operators.tfidf import terms
from webtext.session import materialise


@dataclass(frozen=True)
class NaiveBayesModel:
    """One row per known term, with a weight for each class that has it; for each class two numbers.

    A class's score of a text is its log prior, its log likelihood of an unseen term for each known
    token, and the weights of the tokens it has seen.
    """

    weights: DataFrame
    classes: list
    log_priors: list[float]
    log_unseen: list[float]

    @classmethod
    def fit(cls, df: DataFrame, key: str, text: str, label: str, alpha: float = 1.0) -> "NaiveBayesModel":
        """Add-``alpha`` smoothing of term counts, ``alpha`` above 0; priors are plain class shares.

        ``df`` holds the label in each row, so nothing is joined. Counts are rows of term and class,
        with partial sums before the shuffle; only numbers per class reach the driver.
        """
        labelled = df.filter(F.col(label).isNotNull())
        sizes = labelled.groupBy(label).count().orderBy(label).collect()
        classes = [row[label] for row in sizes]
        rows = sum(row["count"] for row in sizes)
        log_priors = [log(row["count"] / rows) for row in sizes]

        carried = labelled.select(key, text, label).withColumn("_row", F.struct(key, label))
        counts = token_counts(carried, "_row", terms(F.col(text)))
        counted = materialise(
            counts.groupBy("token", F.col(f"_row.{label}").alias("_class")).agg(F.sum("tf").alias("n")), "class-counts"
        )
        known = counted.select("token").distinct().count()
        totals = {row["_class"]: row["n"] for row in counted.groupBy("_class").agg(F.sum("n").alias("n")).collect()}
        log_unseen = [log(alpha / (totals.get(value, 0) + alpha * known)) if known else 0.0 for value in classes]
        number = F.array_position(F.array(*[F.lit(value) for value in classes]), F.col("_class")).cast("int")
        entry = F.struct(number.alias("number"), F.ln((F.col("n") + alpha) / alpha).alias("weight"))
        # A term's group holds one row per class.
        weights = counted.groupBy("token").agg(F.collect_list(entry).alias("entries"))
        return cls(weights, classes, log_priors, log_unseen)

    def predict(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """Most likely class of each row, the first class on a tie: ``(key, prediction)``.

        Unknown terms are dropped; a row without known terms gets the most frequent class.
        """
        counts = token_counts(df.select(key, text), key, terms(F.col(text)), outer=True)
        found = lookup(counts, self.weights, ["token"], key, how="left")
        # The first entry of a term also counts the term's tokens.
        seen = found.select(key, "tf", F.posexplode_outer("entries").alias("_at", "_entry"))
        per_class = seen.groupBy(key, F.col("_entry.number").alias("number")).agg(
            F.sum(F.col("tf") * F.col("_entry.weight")).alias("weight"),
            F.sum(F.when(F.col("_at") == 0, F.col("tf"))).alias("tokens"),
        )
        sums = per_class.groupBy(key).agg(
            F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
            F.map_from_entries(
                F.collect_list(F.when(F.col("number").isNotNull(), F.struct("number", "weight")))
            ).alias("weights"),
        )
        per_number = F.array(*[F.struct(F.lit(p).alias("prior"), F.lit(u).alias("unseen")) for p, u in zip(self.log_priors, self.log_unseen)])
        scored = sums.select(
            key,
            F.transform(
                per_number,
                lambda c, i: c["prior"]
                + F.col("tokens") * c["unseen"]
                + F.coalesce(F.try_element_at("weights", i + 1), F.lit(0.0)),
            ).alias("scores"),
        )
        best = F.array_position("scores", F.array_max("scores")).cast("int")
        return scored.select(key, F.get(F.array(*[F.lit(c) for c in self.classes]), best - 1).alias("prediction"))


def logistic_regression(
    train: DataFrame, test: DataFrame, key: str, vector: str, label: str, c: float = 1.0, iterations: int = 100
) -> DataFrame:
    """Fit on ``train`` and score ``test``: ``(key, probability, prediction)``.

    ``c`` is the inverse strength of the L2 penalty on the sum of losses; Spark averages the
    losses, hence the division by the number of rows.
    """
    labelled = train.filter(F.col(label).isNotNull()).select(
        array_to_vector(vector).alias("features"), F.col(label).cast("double").alias("label")
    )
    prepared = materialise(labelled, "training-rows")
    model = LogisticRegression(
        regParam=1.0 / (c * max(prepared.count(), 1)), maxIter=iterations, standardization=False
    ).fit(prepared)
    scored = model.transform(test.select(key, array_to_vector(vector).alias("features")))
    return scored.select(
        key,
        F.get(vector_to_array("probability"), F.lit(1)).alias("probability"),
        F.col("prediction").cast("int").alias("prediction"),
    )
