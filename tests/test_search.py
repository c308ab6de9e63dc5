"""Grid search over shared folds, keyed results and resumed runs."""

import sys
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rushline.operators import evaluation as ev
from rushline.operators import features as ft
from rushline.operators import search
from rushline.operators import training as tr
from rushline.plans import run
from rushline.plans.run import prepare, read_results, train_all
from rushline.sinks import KeyedTable, RunLog
from rushline.spec import FeatureSpec, ModelSettings, Spec
from tests.data import hourly_table

plan = sys.modules["rushline.plans.run"]
SMALL = ModelSettings(grids={
    "LogisticRegression": {"regParam": [0.0, 0.3], "elasticNetParam": [0.0, 1.0]},
    "DecisionTree": {"maxDepth": [1, 3, 5]}, "RandomForest": {"numTrees": [2, 3]},
}).fitted_with("LogisticRegression", maxIter=15).fitted_with("RandomForest", maxDepth=4)


@pytest.fixture(scope="module")
def vectors(spark):
    rows = ft.complete_rows(prepare(hourly_table(spark, 1_500)))
    model = ft.fit_features(rows)
    kept = tr.training_vectors(
        rows, model, "date_time", [*FeatureSpec().inputs, "label", "fold"], SMALL)
    yield kept
    kept.unpersist()


def test_same_figures_as_sparks_own_search(spark, vectors):
    candidates = tr.candidates(SMALL)
    cells = search.fold_cells(candidates, vectors, SMALL, search.cells_table(spark))
    found = {(r["model"], r["position"]): r for r in search.grid_scores(cells).collect()}
    assert len(found) == 4 + 3 + 2
    for candidate in candidates:
        fitted = tr.cross_validate(candidate, vectors, SMALL, "fold")
        for r in tr.cv_scores(spark, fitted).collect():
            ours = found[candidate.name, r["position"]]
            assert ours["params"] == r["params"] and ours["is_best"] == r["is_best"]
            assert ours["f1"] == pytest.approx(r["f1"], abs=1e-9)
    assert cells.groupBy("fold", "model", "position").count().where("count <> 9").count() == 0
    assert cells.agg(F.sum("n")).first()[0] == 9 * vectors.count()


def test_joined_rows_count_as_their_rows(spark):
    """Equal rows as weighted ones: fewer rows, the same trees, matrices and scores."""
    features = FeatureSpec(scalars=("hour", "is_weekend"), categories=("weather_main",))
    rows = ft.complete_rows(prepare(hourly_table(spark, 1_500)), features)
    model, inputs = ft.fit_features(rows, features), [*features.inputs, "label", "fold"]
    joined = replace(SMALL, whole_rows=300)
    plain, few = (tr.training_vectors(rows, model, "date_time", inputs, s) for s in (SMALL, joined))
    total = rows.count()
    assert tr.WEIGHT not in plain.columns and plain.count() == total
    most = -(-total // 300)
    assert few.count() < total and few.agg(F.sum("weight"), F.max("weight")).first() == (total, most)
    by = ["features", "label", "fold"]
    assert {tuple(r) for r in few.groupBy(by).agg(F.sum("weight")).collect()} == {
        tuple(r) for r in plain.groupBy(by).count().collect()}
    tree = tr.candidates(SMALL)[1]
    trees = [tr.fit_timed(tree, v, SMALL)[0].toDebugString.split("\n")[1:] for v in (plain, few)]
    assert trees[0] == trees[1]
    cells = {r: search.fold_cells(tr.candidates(SMALL), v, SMALL, search.cells_table(spark), r)
             for r, v in (("plain", plain), ("few", few))}
    of_tree = [sorted(tuple(x) for x in c.where("model = 'DecisionTree'").drop("run", "params").collect())
               for c in cells.values()]
    assert of_tree[0] == of_tree[1]
    scores = {(r["model"], r["position"]): r["f1"] for r in search.grid_scores(cells["few"]).collect()}
    for candidate in tr.candidates(SMALL):
        for r in tr.cv_scores(spark, tr.cross_validate(candidate, few, SMALL, "fold")).collect():
            assert scores[candidate.name, r["position"]] == pytest.approx(r["f1"], abs=1e-9)
    for v in (plain, few):
        v.unpersist()


def test_rows_of_all_folds_are_joined_where_no_fold_is_asked_for(spark):
    features = FeatureSpec(scalars=("is_weekend",), categories=())
    rows = ft.complete_rows(prepare(hourly_table(spark, 600)), features)
    vectors = tr.training_vectors(rows, ft.fit_features(rows, features), "date_time",
                                  [*features.inputs, "label"], replace(SMALL, whole_rows=1))
    assert vectors.columns == ["features", "label", "weight"] and vectors.count() <= 2 * 3
    assert vectors.agg(F.sum("weight")).first()[0] == rows.count()
    vectors.unpersist()


def test_finished_folds_are_not_fitted_again(spark, vectors, monkeypatch):
    candidates = tr.candidates(SMALL)[1:2]
    kept = search.cells_table(spark)
    before = search.fold_cells(candidates, vectors, SMALL, kept, "a").orderBy(*search.KEYS, "label", "prediction").collect()
    fits = []
    fitted = search._fitted
    monkeypatch.setattr(search, "_fitted", lambda points, *a: fits.append(len(points)) or fitted(points, *a))
    again = search.fold_cells(candidates, vectors, SMALL, kept, "a")
    assert fits == [] and again.orderBy(*search.KEYS, "label", "prediction").collect() == before
    # another run has its own cells, and a further model adds its points
    search.fold_cells(tr.candidates(SMALL)[1:], vectors, SMALL, kept, "a")
    assert fits == [2, 2, 2]


def test_first_of_equal_points_is_best(spark):
    cells = spark.createDataFrame(
        [("r", f, "m", p, {"x": str(p)}, i, j, 5 if i == j else p // 2)
         for f in range(3) for p in range(4) for i in range(3) for j in range(3)], search.CELLS)
    best = {r["position"]: r["is_best"] for r in search.grid_scores(cells).collect()}
    assert best == {0: True, 1: False, 2: False, 3: False}


def test_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "run string, position int, v string", ["run", "position"])
    assert table.read().count() == 0
    for run_key, position, v in (("a", 0, "x"), ("a", 1, "y"), ("b/ c=", 0, "z"), ("a", 0, "new"), ("a", 0, "new")):
        table.put(spark.createDataFrame([(v, position, run_key)], "v string, position int, run string"))
    assert sorted(tuple(r) for r in table.read().collect()) == [
        ("a", 0, "new"), ("a", 1, "y"), ("b/ c=", 0, "z")]
    assert [f.dataType.simpleString() for f in table.read().schema] == ["string", "int", "string"]
    table.clear()
    assert table.read().count() == 0


class Broken(RuntimeError):
    pass


def test_a_broken_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    """It breaks while the second model is scored; the first is not fitted again."""
    settings = ModelSettings().fitted_with("LogisticRegression", maxIter=5).fitted_with(
        "RandomForest", numTrees=3, maxDepth=4)
    raw, out = hourly_table(spark, 1_000), str(tmp_path)
    fitted, score = [], tr.score

    def breaks(df, model, inputs=None):
        if len(fitted) == 2:
            raise Broken
        return score(df, model, inputs)

    tuned = plan.tuned
    monkeypatch.setattr(plan, "tuned", lambda c, *a: fitted.append(c.name) or tuned(c, *a))
    monkeypatch.setattr(plan.tr, "score", breaks)
    with pytest.raises(Broken):
        run(spark, raw, out, settings=settings, with_charts=False, run_key="k")
    assert fitted == ["LogisticRegression", "DecisionTree"]
    first = read_results(spark, out, "k").collect()
    assert [r["model"] for r in first] == ["LogisticRegression"]

    monkeypatch.setattr(plan.tr, "score", score)
    fitted.clear()
    row = run(spark, raw, out, settings=settings, run_key="k", resume=True).first()
    assert fitted == ["DecisionTree", "RandomForest"]
    assert [m["model"] for m in row["model_results"]] == [
        "LogisticRegression", "DecisionTree", "RandomForest"]
    assert row["model_results"][0]["train_time_s"] == first[0]["train_time_s"]

    # once more: nothing is left to fit, no row is doubled
    fitted.clear()
    again = run(spark, raw, out, settings=settings, with_charts=False, run_key="k", resume=True).first()
    assert fitted == [] and again["model_results"] == row["model_results"]
    # another key is a run of its own; without resume earlier results go
    train_all(spark.read.parquet(f"{out}/observations"), spark.read.parquet(f"{out}/observations").where(
        "split = 'test'"), out, Spec(), FeatureSpec(), settings, RunLog(spark, None, "x"), "other", True)
    assert read_results(spark, out, "k").count() == read_results(spark, out, "other").count() == 3
    run(spark, raw, out, settings=settings, with_charts=False)
    assert read_results(spark, out, "k").count() == 0 and read_results(spark, out).count() == 3


def test_a_tuned_run_uses_its_search(spark, tmp_path):
    settings = ModelSettings(tune=True, params={"DecisionTree": {"maxDepth": 2, "maxBins": 64}},
                             grids={"DecisionTree": {"maxDepth": [1, 6]}})
    row = run(spark, hourly_table(spark, 1_000), str(tmp_path), settings=settings,
              with_charts=False).first()
    assert row["model_results"][0]["parameters"]["maxDepth"] == "6"
    cells = search.cells_table(spark, str(tmp_path / "results" / "search")).read()
    assert cells.select("fold", "position").distinct().count() == 6
    assert ev.weighted_metrics(cells, by=["position"]).count() == 2
