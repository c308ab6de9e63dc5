"""Published matrices and metrics."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from rushline.operators import evaluation as ev

# Rows actual, columns predicted, order high, low, medium.
MATRICES = {
    "LogisticRegression": [[48, 138, 1123], [133, 2599, 1603], [61, 1508, 3095]],
    "DecisionTree": [[1003, 0, 306], [0, 4050, 285], [149, 161, 4354]],
    "RandomForest": [[946, 0, 363], [0, 4076, 259], [96, 147, 4421]],
}
METRICS = {
    "LogisticRegression": (0.5570, 0.5232, 0.5570, 0.5298),
    "DecisionTree": (0.9126, 0.9134, 0.9126, 0.9121),
    "RandomForest": (0.9161, 0.9179, 0.9161, 0.9149),
}
CLASS_F1 = {
    "LogisticRegression": {"high": 0.0619, "low": 0.6058, "medium": 0.5904},
    "DecisionTree": {"high": 0.8151, "low": 0.9478, "medium": 0.9062},
    "RandomForest": {"high": 0.8048, "low": 0.9526, "medium": 0.9109},
}
SUPPORT = {"high": 1309, "low": 4335, "medium": 4664}


@pytest.fixture(scope="module")
def matrices(spark):
    rows = [(m, i, j, n) for m, cells in MATRICES.items()
            for i, row in enumerate(cells) for j, n in enumerate(row)]
    return spark.createDataFrame(rows, "model string, label int, prediction int, n bigint")


@pytest.fixture(scope="module")
def results(matrices):
    order = F.when(F.col("model") == "LogisticRegression", 0).when(
        F.col("model") == "DecisionTree", 1).otherwise(2)
    return ev.weighted_metrics(matrices, ["model"]).withColumn("position", order)


def test_published_metrics(results):
    for row in results.collect():
        assert tuple(round(row[m], 4) for m in ev.METRICS) == METRICS[row["model"]]
        assert row["n_rows"] == 10308


def test_published_class_metrics(matrices):
    rows = ev.per_class(matrices, ["model"]).collect()
    assert len(rows) == 9
    for row in rows:
        assert round(row["f1"], 4) == CLASS_F1[row["model"]][row["level"]]
        assert row["support"] == SUPPORT[row["level"]]


def test_best_worst_and_gaps(matrices, results):
    row = ev.best_and_worst(results, order="position").first()
    assert (row["best"], row["worst"]) == ("RandomForest", "LogisticRegression")
    assert round(row["f1_gap_points"], 1) == 38.5
    gap = ev.model_gap(results, "RandomForest", "DecisionTree").first()
    assert gap["leader"] == "RandomForest" and round(gap["gap_points"], 2) == 0.28
    recall = ev.recall_range(ev.per_class(matrices, ["model"])).first()
    assert recall["model"] == "RandomForest"
    assert (round(recall["min_recall"], 3), round(recall["max_recall"], 3)) == (0.723, 0.948)


def test_a_tie_goes_to_the_first_model(spark):
    tied = spark.createDataFrame(
        [("b", 0, 0.5), ("a", 1, 0.5), ("c", 2, 0.5)], "model string, position int, f1 double")
    row = ev.best_and_worst(tied, order="position").first()
    assert (row["best"], row["worst"]) == ("b", "b")


def test_confusion_is_dense_and_equals_the_evaluator(spark):
    df = spark.range(1_000).select(
        (F.col("id") % 2).cast("double").alias("label"),
        F.when(F.col("id") % 7 == 0, 2).otherwise(F.col("id") % 2).cast("double")
        .alias("prediction"))
    matrix = ev.confusion(df)
    assert matrix.count() == 9 and matrix.agg(F.sum("n")).first()[0] == 1_000
    ours = ev.weighted_metrics(matrix).first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision",
             "recall": "weightedRecall", "f1": "f1"}
    for metric, name in names.items():
        expected = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert ours[metric] == pytest.approx(expected, abs=1e-12)
    medium = ev.per_class(matrix).filter("level = 'medium'").first()
    assert (medium["precision"], medium["recall"], medium["f1"]) == (0.0, 0.0, 0.0)


def test_rows_without_prediction_are_in_no_cell(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, None)], "label double, prediction double")
    assert ev.confusion(df).agg(F.sum("n")).first()[0] == 1


def test_long_and_named_forms(matrices, results):
    assert ev.metrics_long(results.select("model", *ev.METRICS)).count() == 12
    named = ev.named_confusion(matrices, ["model"])
    row = named.filter(
        "model = 'DecisionTree' and actual = 'medium' and predicted = 'low'").first()
    assert row["n"] == 161
