"""Classification metrics from a confusion table, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.splits import LABEL


def baseline_accuracy(rows: DataFrame) -> DataFrame:
    """Accuracy of always predicting 1, and the number of rows."""
    return rows.agg(
        F.avg(F.col(LABEL)).alias("baseline_accuracy"), F.count("*").alias("rows")
    )


def confusion(scored: DataFrame) -> DataFrame:
    """Rows per (label, prediction); at most one row per pair of classes."""
    return scored.groupBy(
        F.col(LABEL).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count("*").alias("rows"))


def scores(scored: DataFrame) -> DataFrame:
    """One row: accuracy and the F1 score of class 1 (0 when class 1 never occurs)."""
    n = F.col("rows")
    label, prediction = F.col("label"), F.col("prediction")
    hits = F.sum(F.when((label == 1) & (prediction == 1), n).otherwise(0))
    misses = F.sum(F.when((label == 1) != (prediction == 1), n).otherwise(0))
    right = F.sum(F.when(label == prediction, n).otherwise(0))
    return confusion(scored).agg(
        F.try_divide(right, F.sum(n)).alias("accuracy"),
        F.coalesce(F.try_divide(2 * hits, 2 * hits + misses), F.lit(0.0)).alias("f1_score"),
    )


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then the macro and weighted averages.

    Rows are named by ``scope``: the class number, "macro avg" or "weighted avg". Every row
    carries the overall accuracy. The scored rows are read once; from the confusion table on
    there are only a few rows per class.
    """
    n, label, prediction = F.col("rows"), F.col("label"), F.col("prediction")
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(label.alias("class"), n.alias("actual"), none.alias("predicted"),
                 F.when(label == prediction, n).otherwise(none).alias("right")),
        F.struct(prediction.alias("class"), none.alias("actual"), n.alias("predicted"),
                 none.alias("right")),
    )
    counts = (
        confusion(scored)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "right")])
    )
    right, actual, predicted = F.col("right"), F.col("actual"), F.col("predicted")
    measures = {
        "precision": F.try_divide(right, predicted),
        "recall": F.try_divide(right, actual),
        "f1_score": F.try_divide(2 * right, predicted + actual),
    }
    one = F.lit(1.0)
    scopes = F.array(
        F.struct(F.col("class").cast("string").alias("scope"), one.alias("share")),
        F.struct(F.lit("macro avg").alias("scope"), one.alias("share")),
        F.struct(F.lit("weighted avg").alias("scope"), actual.cast("double").alias("share")),
    )
    return (
        counts.select(
            "actual", "right", F.inline(scopes),
            *[F.coalesce(value, F.lit(0.0)).alias(name) for name, value in measures.items()],
        )
        .groupBy("scope")
        .agg(
            *[F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("share")), F.sum("share")),
                         F.lit(0.0)).alias(m) for m in measures],
            F.sum("actual").alias("support"),
            F.try_divide(F.sum("right"), F.sum("actual")).alias("_right"),
        )
        .withColumn(
            "accuracy",
            F.max(F.when(F.col("scope") == "macro avg", F.col("_right"))).over(
                Window.partitionBy(F.lit(0))
            ),
        )
        .drop("_right")
    )


def pick_winner(results: DataFrame) -> DataFrame:
    """The contender of highest accuracy; on a tie the one with the lower ``priority``."""
    best = F.min_by(F.struct(*results.columns), F.struct(-F.col("accuracy"), F.col("priority")))
    return results.agg(best.alias("best")).select("best.*")
