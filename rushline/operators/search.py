"""Grid search over folds that all points share (M4, M5)."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rushline.operators import evaluation as ev
from rushline.operators.training import WEIGHT, Candidate, weighted
from rushline.sinks import KeyedTable, scratch_uri
from rushline.spec import ModelSettings

CELLS = ("run string, fold int, model string, position int, params map<string,string>, "
         "label int, prediction int, n bigint")
KEYS = ("run", "fold", "model", "position")


def cells_table(spark, uri: str | None = None) -> KeyedTable:
    """Where a search keeps its matrices: a cell each, by run, fold, model and grid point."""
    return KeyedTable(spark, uri or scratch_uri(spark, "search"), CELLS, KEYS)


def fold_cells(
    candidates: Sequence[Candidate], vectors: DataFrame, settings: ModelSettings,
    kept: KeyedTable, run: str = "search", fold: str = "fold",
) -> DataFrame:
    """The matrix of every grid point of every candidate on every fold, as cells of ``kept``.

    ``vectors`` (features, label and the fold column) are the laid-out training
    rows. A fold's training rows are filtered from them and kept on the executors'
    disks once, for all points of all grids; its held-out rows are scored by all of
    the fold's models in one pass, which counts one row of cells per task. Points
    found in ``kept`` are not fitted again, so a broken search goes on where it
    stopped: fold by fold, all matrices of a fold are put together.
    """
    done = {tuple(r) for r in kept.read().where(F.col("run") == run).select(
        "fold", "model", "position").distinct().collect()}
    points = [(c, i, point) for c in candidates for i, point in enumerate(c.grid)]
    for number in range(settings.folds):
        left = [p for p in points if (number, p[0].name, p[1]) not in done]
        if not left:
            continue
        train = vectors.where(F.col(fold) != number).persist(StorageLevel.DISK_ONLY)
        try:
            models = _fitted(left, train, settings)
            kept.put(_counted(left, models, vectors.where(F.col(fold) == number)).select(
                F.lit(run).alias("run"), F.lit(number).alias("fold"), "*"))
        finally:
            train.unpersist()
    return kept.read().where(F.col("run") == run)


def _fitted(points, train: DataFrame, settings: ModelSettings) -> list[Model]:
    """One model per point, ``parallel_fits`` at a time."""
    def fit(point) -> Model:
        candidate, _, params = point
        return weighted(candidate.estimator, train).fit(train, params)

    with ThreadPool(max(1, settings.parallel_fits)) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(fit), points, chunksize=1)


def _counted(points, models: Sequence[Model], held_out: DataFrame) -> DataFrame:
    """Cells (model, position, params, label, prediction, n) from one pass over the rows."""
    weight = [WEIGHT] if WEIGHT in held_out.columns else []
    scored = held_out.select("features", "label", *weight)
    for i, model in enumerate(models):
        named = model.copy({model.predictionCol: f"p{i}", model.rawPredictionCol: "",
                            model.probabilityCol: ""})
        scored = named.transform(scored)
    found = F.array(*[
        F.struct(F.lit(c.name).alias("model"), F.lit(position).alias("position"),
                 F.col(f"p{i}").alias("prediction"))
        for i, (c, position, _) in enumerate(points)])
    cells = ev.confusion(scored.select("label", *weight, F.inline(found)), by=["model", "position"],
                         weight=next(iter(weight), None))
    params = F.lit(None).cast("map<string,string>")
    for c, position, point in points:
        pairs = [F.lit(x) for p, v in point.items() for x in (p.name, str(v))]
        here = (F.col("model") == c.name) & (F.col("position") == position)
        params = F.when(here, F.create_map(*pairs).cast("map<string,string>")).otherwise(params)
    return cells.select("model", "position", params.alias("params"),
                        F.col("label").cast("int").alias("label"),
                        F.col("prediction").cast("int").alias("prediction"), "n")


def grid_scores(cells: DataFrame) -> DataFrame:
    """(model, position, params, f1, is_best): weighted f1 averaged over the folds.

    Of equal points of a model the first is best. Follows from the cells alone.
    """
    by = ["model", "position", "fold"]
    averages = ev.weighted_metrics(cells, by=by).groupBy("model", "position").agg(
        F.avg("f1").alias("f1"))
    params = cells.groupBy("model", "position").agg(F.first("params").alias("params"))
    # one row per point of a grid
    order = Window.partitionBy("model").orderBy(F.desc("f1"), "position")
    return averages.join(params, ["model", "position"]).select(
        "model", "position", "params", "f1", (F.row_number().over(order) == 1).alias("is_best"))


def best_points(candidates: Sequence[Candidate], scores: DataFrame) -> dict[str, int]:
    """Position of the best grid point by model name."""
    return {r["model"]: r["position"] for r in scores.where("is_best").collect()}


def tuned_models(
    candidates: Sequence[Candidate], vectors: DataFrame, settings: ModelSettings,
    kept: KeyedTable, run: str = "search", fold: str = "fold",
) -> tuple[dict[str, Candidate], DataFrame]:
    """Each candidate with the parameters of its best point, and the scores of the search."""
    scores = grid_scores(fold_cells(candidates, vectors, settings, kept, run, fold))
    best = best_points(candidates, scores)
    chosen = {c.name: Candidate(c.name, c.estimator.copy(c.grid[best[c.name]]), []) for c in candidates}
    return chosen, scores
