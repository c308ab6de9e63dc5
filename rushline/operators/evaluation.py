"""Classifier evaluation from one confusion aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rushline.spec import LEVEL_INDEX

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    prediction: str = "prediction",
    n_classes: int = len(LEVEL_INDEX),
    weight: str | None = None,
) -> DataFrame:
    """Dense (label, prediction, n), zeros included, from a single pass.

    Every cell is its own conditional count, so one task output row holds the
    whole matrix and there is no grid to join. Rows without a prediction are
    in no cell. ``weight`` says how many rows a row stands for.
    """
    classes = range(n_classes)

    def counted(cell):
        if weight is None:
            return F.count_if(cell)
        return F.coalesce(F.sum(F.when(cell, F.col(weight).cast("bigint"))), F.lit(0).cast("bigint"))

    cells = F.array(*[
        F.struct(
            F.lit(i).alias("label"),
            F.lit(j).alias("prediction"),
            counted((F.col(label) == i) & (F.col(prediction) == j)).alias("n"),
        )
        for i in classes for j in classes
    ])
    return df.groupBy(*by).agg(cells.alias("cells")).select(*by, F.inline("cells"))


def named_confusion(
    matrix: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = LEVEL_INDEX
) -> DataFrame:
    """Confusion cells with class names for actual and predicted."""
    names = F.array(*[F.lit(x) for x in labels])
    return matrix.select(
        *by,
        F.get(names, F.col("label").cast("int")).alias("actual"),
        F.get(names, F.col("prediction").cast("int")).alias("predicted"),
        "n",
    )


def per_class(
    matrix: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = LEVEL_INDEX
) -> DataFrame:
    """precision, recall, f1 and support per class; 0.0 on a zero denominator.

    Each cell counts once for its row's class and once for its column's class.
    """
    shares = F.array(
        F.struct(
            F.col("label").cast("int").alias("class"),
            F.col("n").alias("actual"),
            F.lit(0).cast("bigint").alias("claimed"),
            F.when(F.col("label") == F.col("prediction"), F.col("n"))
            .otherwise(0).cast("bigint").alias("hit"),
        ),
        F.struct(
            F.col("prediction").cast("int").alias("class"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("claimed"),
            F.lit(0).cast("bigint").alias("hit"),
        ),
    )
    sums = (
        matrix.select(*by, F.inline(shares)).groupBy(*by, "class")
        .agg(F.sum("actual").alias("support"), F.sum("claimed").alias("claimed"),
             F.sum("hit").alias("hit"))
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    names = F.array(*[F.lit(x) for x in labels])
    return (
        sums.withColumns({
            "precision": ratio(F.col("hit").cast("double"), F.col("claimed").cast("double")),
            "recall": ratio(F.col("hit").cast("double"), F.col("support").cast("double")),
        })
        .withColumn("f1", ratio(
            2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .select(
            *by, F.get(names, F.col("class")).alias("level"),
            "precision", "recall", "f1", "support", "hit",
        )
    )


def weighted_metrics(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy and support-weighted precision, recall and f1."""
    classes = per_class(matrix, by)
    total = F.sum("support")

    def weighted(metric: str):
        return F.try_divide(F.sum(F.col(metric) * F.col("support")), total).alias(metric)

    return classes.groupBy(*by).agg(
        F.try_divide(F.sum("hit"), total).alias("accuracy"),
        weighted("precision"), weighted("recall"), weighted("f1"),
        total.alias("n_rows"),
    )


def metrics_long(results: DataFrame, model: str = "model") -> DataFrame:
    """One row per model and metric."""
    return results.unpivot(model, list(METRICS), "metric", "value")


def best_and_worst(results: DataFrame, model: str = "model", order: str | None = None) -> DataFrame:
    """Names of the best and worst model by f1; a tie goes to the first in ``order``."""
    first = F.col(order) if order else F.lit(0)
    # Negated order: among equal scores the largest is the first model.
    return results.agg(
        F.max_by(model, F.struct("f1", -first)).alias("best"),
        F.min_by(model, F.struct(F.col("f1"), first)).alias("worst"),
        ((F.max("f1") - F.min("f1")) * 100).alias("f1_gap_points"),
    )


def model_gap(results: DataFrame, first: str, second: str, model: str = "model") -> DataFrame:
    """Absolute f1 difference of two named models in percentage points."""
    def score(name: str):
        return F.max(F.when(F.col(model) == name, F.col("f1")))
    return results.agg(
        F.when(score(first) >= score(second), first).otherwise(second).alias("leader"),
        (F.abs(score(first) - score(second)) * 100).alias("gap_points"),
    )


def recall_range(classes: DataFrame, model: str = "model") -> DataFrame:
    """Smallest and largest per-class recall of the model with the best weighted f1.

    Works on the per-class table alone: the weighted f1 is its support-weighted
    average. Equal scores go to the first name.
    """
    models = classes.groupBy(model).agg(
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"),
        F.min("recall").alias("min_recall"),
        F.max("recall").alias("max_recall"),
    )
    return models.orderBy(F.desc("f1"), F.asc(model)).limit(1).drop("f1")
