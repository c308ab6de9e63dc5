"""Fit, tune, score and persist classifiers."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rushline.operators import evaluation as ev
from rushline.operators.features import slot_names, slot_source
from rushline.sinks import scratch_uri, write_table
from rushline.spec import LEVEL_INDEX, FeatureSpec, ModelSettings


@dataclass(frozen=True)
class Candidate:
    name: str
    estimator: Estimator
    grid: list


ESTIMATORS = {
    "LogisticRegression": LogisticRegression,
    "DecisionTree": DecisionTreeClassifier,
    "RandomForest": RandomForestClassifier,
}


def candidate(name: str, settings: ModelSettings = ModelSettings()) -> Candidate:
    """One classifier with its parameters and its tuning grid, all by name."""
    estimator = ESTIMATORS[name](**settings.params[name])
    # With the nodes that rows have reached kept, no pass of a deep tree starts at its root.
    for shared, value in (("seed", settings.seed), ("maxMemoryInMB", settings.tree_memory_mb),
                          ("cacheNodeIds", True)):
        if estimator.hasParam(shared):
            estimator.set(estimator.getParam(shared), value)
    grid = ParamGridBuilder()
    for param, values in settings.grids[name].items():
        grid.addGrid(estimator.getParam(param), values)
    return Candidate(name, estimator, grid.build())


def candidates(settings: ModelSettings = ModelSettings()) -> list[Candidate]:
    return [candidate(name, settings) for name in settings.params]


def cross_validate(candidate: Candidate, train: DataFrame, settings: ModelSettings,
                   fold: str | None = None) -> CrossValidatorModel:
    """k-fold search on weighted f1; ``fold`` names a fold column made from a key hash."""
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    if WEIGHT in train.columns:
        evaluator.setWeightCol(WEIGHT)
    search = CrossValidator(
        estimator=weighted(candidate.estimator, train),
        estimatorParamMaps=candidate.grid,
        evaluator=evaluator,
        numFolds=settings.folds,
        parallelism=settings.parallel_fits,
        seed=settings.seed,
    )
    if fold:
        search = search.setFoldCol(fold)
    return search.fit(train)


def cv_scores(spark: SparkSession, fitted: CrossValidatorModel) -> DataFrame:
    """(position, params, f1, is_best) per grid point."""
    best = max(range(len(fitted.avgMetrics)), key=lambda i: fitted.avgMetrics[i])
    rows = [
        (i, {p.name: str(v) for p, v in point.items()}, float(f1), i == best)
        for i, (point, f1) in enumerate(zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics))
    ]
    return spark.createDataFrame(
        rows, "position int, params map<string,string>, f1 double, is_best boolean")


def fit_timed(candidate: Candidate, train: DataFrame, settings: ModelSettings,
              fold: str | None = None) -> tuple[Model, float]:
    """The fitted (or best tuned) model and the seconds it took."""
    if settings.tune:
        return timed(lambda: cross_validate(candidate, train, settings, fold).bestModel)
    return timed(lambda: weighted(candidate.estimator, train).fit(train))


def weighted(estimator: Estimator, train: DataFrame) -> Estimator:
    """The estimator, made to count each row by its weight where rows have one."""
    if WEIGHT not in train.columns:
        return estimator
    return estimator.copy({estimator.getParam("weightCol"): WEIGHT})


def timed(fit: Callable[[], Model]) -> tuple[Model, float]:
    """What ``fit`` returns and the seconds it took."""
    started = time.monotonic()
    return fit(), time.monotonic() - started


# Small tables are cut into this many values per task, up to the given number of
# tasks; beyond that, tasks grow to the large size first.
SMALL_TASK, FEW_TASKS, LARGE_TASK = 130_000, 64, 16_000_000


def layout_partitions(n_rows: int, width: int) -> int:
    """Partitions for rows of so many values: a function of the data alone."""
    values = n_rows * max(width, 1)
    return max(1, min(FEW_TASKS, -(-values // SMALL_TASK)), -(-values // LARGE_TASK))


def training_layout(
    rows: DataFrame, key: str, n_rows: int, partitions: int | None = None
) -> DataFrame:
    """Training rows in balanced, repeatable partitions.

    Split candidates of a tree are sampled per partition, and a forest draws its
    rows per partition, so the same seed gives the same model only for the same
    layout. The number of partitions follows from the data (or is given), never
    from the machine. Rows go to partitions by the hash of the whole row, not of
    the key: a key that many rows share does not fill one partition.
    """
    n = partitions or layout_partitions(n_rows, len(rows.columns))
    rest = [c for c in rows.columns if c != key]
    return rows.repartition(n, F.xxhash64(key, *rest)).sortWithinPartitions(key, *rest)


#: The column of a training row that stands for several: how many.
WEIGHT = "weight"


def joined_rows(rows: DataFrame, most: int) -> DataFrame:
    """Equal rows as few rows with a weight, ``most`` or less, and a number among equals.

    Every row counts: the weights of a value add up to its rows. Counts fold in the
    map tasks, so what is shuffled follows the distinct rows.
    """
    parts = F.ceil(F.col(WEIGHT) / most)
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(WEIGHT))
    numbered = counted.withColumns({
        "parts": parts, "part": F.explode(F.sequence(F.lit(1).cast("bigint"), parts))})
    share = F.floor(F.col(WEIGHT) * F.col("part") / F.col("parts")) - F.floor(
        F.col(WEIGHT) * (F.col("part") - 1) / F.col("parts"))
    return numbered.select(*rows.columns, "part", share.cast("double").alias(WEIGHT))


def training_vectors(
    train: DataFrame, feature_model: PipelineModel, key: str, columns: Sequence[str],
    settings: ModelSettings = ModelSettings(),
) -> DataFrame:
    """The laid-out training vectors, kept on the executors' disks for all fits.

    Beyond ``settings.whole_rows`` rows, equal ones (without the key) are joined and
    have a weight, so fits grow with the distinct rows. All classifiers here add
    weights up as they add rows up; a forest draws its rows by whole joined rows, of
    which so many are left that no draw is coarser than that of ``whole_rows`` rows.
    The caller unpersists the vectors after the last fit; what a lost executor held
    is laid out again from the stored rows.
    """
    rows, n_rows = train.select(*dict.fromkeys([key, *columns])), train.count()
    kept = ["features", *(c for c in ("label", "fold") if c in rows.columns)]
    if n_rows > settings.whole_rows:
        inputs = rows.select(*dict.fromkeys(columns))
        rows, key = write_table(joined_rows(inputs, -(-n_rows // settings.whole_rows)), scratch_uri(
            train.sparkSession, "joined_rows")), "part"
        n_rows = rows.count()
        kept.append(WEIGHT)
    laid_out = training_layout(rows, key, n_rows, settings.partitions)
    return feature_model.transform(laid_out).select(*kept).persist(StorageLevel.DISK_ONLY)


REPORTED_PARAMS = (
    "maxIter", "regParam", "elasticNetParam", "maxDepth", "maxBins",
    "numTrees", "subsamplingRate", "featureSubsetStrategy",
)


def fitted_params(model: Model) -> dict[str, str]:
    """Hyper-parameters the model was fitted with, read as params, plus its class."""
    found = {
        name: str(model.getOrDefault(name))
        for name in REPORTED_PARAMS
        if model.hasParam(name) and model.isDefined(name)
    }
    return {**found, "class": type(model).__name__}


def score(df: DataFrame, model: PipelineModel, inputs: Sequence[str] | None = None) -> DataFrame:
    """prediction, predicted_level and p_high/p_low/p_medium per row.

    Narrow: no shuffle. A row that lacks one of ``inputs`` gets NULL instead of
    what the model makes of a NaN.
    """
    complete = F.lit(True)
    for c in inputs or FeatureSpec().scalars:
        complete = complete & F.col(c).isNotNull()
    shares = vector_to_array("probability")
    names = F.array(*[F.lit(x) for x in LEVEL_INDEX])
    scored = model.transform(df).withColumn(
        "prediction", F.when(complete, F.col("prediction")))
    return scored.withColumns({
        "predicted_level": F.get(names, F.col("prediction").cast("int")),
        **{
            f"p_{name}": F.when(complete, F.get(shares, F.lit(i)))
            for i, name in enumerate(LEVEL_INDEX)
        },
    })


def importances(model: Model, features: DataFrame, spec: FeatureSpec = FeatureSpec(),
                by_source: bool = False) -> DataFrame:
    """(feature, importance) with the real slot names; optionally summed per source column."""
    names = slot_names(features)
    rows = [(n, slot_source(n, spec), float(v))
            for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
    table = features.sparkSession.createDataFrame(
        rows, "feature string, source string, importance double")
    if by_source:
        return table.groupBy(F.col("source").alias("feature")).agg(
            F.sum("importance").alias("importance"))
    return table.select("feature", "importance")


def result_row(position: int, name: str, seconds: float, model: Model,
               scored: DataFrame) -> DataFrame:
    """One row about one model: metrics, matrix, importances and parameters.

    The test rows are scored and counted once; every metric comes from the
    nine cells of that count.
    """
    # Nine cells as one array, kept beside the rows the metrics are taken from.
    cells = ev.confusion(scored).agg(F.array_sort(F.collect_list(F.struct(
        "label", "prediction", "n"))).alias("cells"))
    matrix = cells.select("cells", F.inline("cells"))
    weights = (
        [round(float(v), 4) for v in model.featureImportances.toArray()]
        if hasattr(model, "featureImportances") else []
    )
    params = [x for k, v in sorted(fitted_params(model).items()) for x in (F.lit(k), F.lit(v))]
    n = len(LEVEL_INDEX)
    square = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.transform(F.slice("cells", i * n + 1, n), lambda c: c.getField("n")),
    )
    metrics = ev.weighted_metrics(matrix, by=["cells"])
    return metrics.select(
        F.lit(position).alias("position"),
        F.lit(name).alias("model"),
        F.lit(round(seconds, 3)).alias("train_time_s"),
        *[F.round(m, 4).alias(m) for m in ev.METRICS],
        "n_rows",
        square.alias("confusion_matrix"),
        F.array(*[F.lit(w) for w in weights]).cast("array<double>").alias("feature_importances"),
        F.create_map(*params).alias("parameters"),
    )


def full_model(feature_model: PipelineModel, model: Model) -> PipelineModel:
    """Feature stages and classifier as one model that scores rows without a vector."""
    return PipelineModel(stages=[*feature_model.stages, model])


def save_model(model: PipelineModel, uri: str) -> str:
    model.write().overwrite().save(uri)
    return uri


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)
