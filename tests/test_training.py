"""I1-I7, M1-M11 on a table whose level follows hour and weekday."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from rushline.operators import evaluation as ev
from rushline.operators import features as ft
from rushline.operators import split as sp
from rushline.operators import training as tr
from rushline.plans.run import prepare
from rushline.sinks import scratch_uri, write_table
from rushline.spec import FeatureSpec, ModelSettings
from tests.data import hourly_table

SETTINGS = ModelSettings().fitted_with("LogisticRegression", maxIter=20).fitted_with(
    "RandomForest", numTrees=8, maxDepth=8)


@pytest.fixture(scope="module")
def prepared(spark):
    return prepare(hourly_table(spark, 4_000)).persist()


@pytest.fixture(scope="module")
def sets(spark, prepared):
    train = ft.complete_rows(prepared.filter("split = 'train'"))
    feature_model = ft.fit_features(train)
    laid_out = tr.training_layout(train, "date_time", train.count())
    vectors = feature_model.transform(laid_out).select("features", "label", "fold").persist()
    return vectors, prepared.filter("split = 'test'"), feature_model


def _candidate(name):
    return tr.candidate(name, SETTINGS)


def test_three_candidates_each_with_a_grid(spark):
    names = [c.name for c in tr.candidates()]
    assert names == ["LogisticRegression", "DecisionTree", "RandomForest"]
    assert [len(c.grid) for c in tr.candidates()] == [6, 4, 4]


def test_trees_keep_the_nodes_that_rows_have_reached(spark):
    for name in ("DecisionTree", "RandomForest"):
        assert _candidate(name).estimator.getCacheNodeIds()


def test_split_is_stable_and_close_to_the_share(prepared):
    counts = {r["split"]: r["n"] for r in sp.split_counts(prepared).collect()}
    assert sum(counts.values()) == 4_000 and abs(counts["train"] / 4_000 - 0.8) < 0.03
    again = sp.add_split(prepared.drop("split").repartition(11), "date_time")
    assert again.exceptAll(prepared.select(again.columns)).isEmpty()


def test_split_of_a_time_does_not_depend_on_the_session_zone(spark, prepared):
    before = {r["date_time"]: r["split"] for r in prepared.select("date_time", "split").collect()}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        again = sp.add_split(hourly_table(spark, 4_000), "date_time").select("date_time", "split")
        after = {r["date_time"]: r["split"] for r in again.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert set(after.values()) == {"train", "test"} and after == before


def test_sample_is_stable(prepared):
    first = sp.sample_rows(prepared, "date_time", 50).collect()
    assert sp.sample_rows(prepared.repartition(7), "date_time", 50).collect() == first


def test_index_by_frequency_then_value(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "b", "a", "a", "c", None)], "v string")
    rows = {r["value"]: r["index"] for r in ft.category_index(df, "v").collect()}
    assert rows == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_wide_vocabulary_is_whole(spark):
    df = spark.range(3_000).select((F.col("id") % 1_500).cast("string").alias("v"), "id")
    assert len(ft.fit_vocabulary(df, ["v"])["v"]) == 1_500
    rows = ft.category_index(df, "v").orderBy("index").collect()
    assert [r["value"] for r in rows] == sorted(str(i) for i in range(1_500))
    assert [r["index"] for r in rows] == list(map(float, range(1_500)))
    spec = FeatureSpec(scalars=("id",), categories=("v",))
    assert ft.fit_features(df, spec).transform(df).first()["features"].size == 1_501


def test_features_without_categories(spark, prepared):
    spec = FeatureSpec(scalars=("hour", "temp_c"), categories=())
    built = ft.fit_features(prepared, spec).transform(prepared)
    assert ft.slot_names(built) == ["hour", "temp_c"]
    fitted, _ = tr.fit_timed(_candidate("DecisionTree"), built, SETTINGS)
    assert fitted.numFeatures == 2


def test_counts_grow_with_the_sum_of_two_wide_columns(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 1_000).cast("string").alias("a"),
        (F.floor(F.col("id") / 40) % 1_000).cast("string").alias("b"))
    assert ft.vocabulary_counts(df, ["a", "b"]).count() == 2_000


def test_another_salt_draws_another_split(prepared):
    shares = {}
    for salt, share in (("", 0.8), ("x", 0.8), ("x", 0.855)):
        rows = sp.add_split(prepared.drop("split"), "date_time", share, salt)
        train = {r["date_time"] for r in rows.filter("split = 'train'").collect()}
        assert abs(len(train) / 4_000 - share) < 0.03
        shares[salt, share] = train
    assert shares["", 0.8] != shares["x", 0.8]


def test_many_folds_are_even(spark):
    df = sp.add_fold(spark.range(20_000), "id", 130)
    sizes = [r["count"] for r in df.groupBy("fold").count().collect()]
    assert len(sizes) == 130 and min(sizes) > 100 and max(sizes) < 220


def test_labels_are_alphabetical_and_strict(spark):
    df = spark.createDataFrame([("high",), ("low",), ("medium",)], "congestion string")
    assert [r["label"] for r in ft.add_label(df).collect()] == [0.0, 1.0, 2.0]
    with pytest.raises(Exception, match="unknown level"):
        ft.add_label(spark.createDataFrame([("huge",)], "congestion string")).collect()


def test_vector_width_names_and_unknown_categories(spark, prepared, sets):
    _, _, feature_model = sets
    built = feature_model.transform(prepared)
    names = ft.slot_names(built)
    assert names[:9] == list(FeatureSpec().scalars)
    seasons = prepared.select("season").distinct().count()
    assert len(names) == 9 + 7 + seasons
    assert ft.slot_source("weather_main_vec_Fog") == "weather_main"
    odd = feature_model.transform(
        prepared.limit(1).withColumn("weather_main", F.lit("Tornado"))).first()["features"]
    assert all(odd[i] == 0 for i, n in enumerate(names) if n.startswith("weather_main"))


def test_trees_beat_the_line(sets):
    vectors, test, feature_model = sets
    scores = {}
    for name in ("LogisticRegression", "DecisionTree", "RandomForest"):
        fitted, seconds = tr.fit_timed(_candidate(name), vectors, SETTINGS)
        scored = tr.score(test, tr.full_model(feature_model, fitted))
        row = tr.result_row(0, name, seconds, fitted, scored).first()
        scores[name] = row["f1"]
        assert sum(map(sum, row["confusion_matrix"])) == row["n_rows"] == test.count()
        matrix = ev.confusion(scored).collect()
        assert all(row["confusion_matrix"][c["label"]][c["prediction"]] == c["n"] for c in matrix)
        assert row["train_time_s"] > 0 and row["parameters"]["class"] == type(fitted).__name__
        if name == "RandomForest":
            assert row["parameters"]["numTrees"] == "8"
            assert sum(row["feature_importances"]) == pytest.approx(1, abs=0.01)
    assert scores["DecisionTree"] > 0.95 > scores["LogisticRegression"]


def test_same_layout_same_tree(sets, prepared):
    vectors, _, feature_model = sets
    train = ft.complete_rows(prepared.filter("split = 'train'"))
    again = feature_model.transform(
        tr.training_layout(train.repartition(5), "date_time", train.count())
    ).select("features", "label")
    trees = [_candidate("DecisionTree").estimator.fit(v).toDebugString.split("\n")[1:]
             for v in (vectors, again)]
    assert trees[0] == trees[1]


def test_layout_spreads_a_hot_key(spark):
    df = spark.range(520_000).select(F.lit(1).alias("k"), "id")
    sizes = [r["n"] for r in tr.training_layout(df, "k", 520_000).groupBy(
        F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == tr.layout_partitions(520_000, 2) == 8 and max(sizes) < 520_000 / 4
    assert [tr.layout_partitions(n, 10) for n in (0, 10, 10**6, 10**12)] == [1, 1, 64, 625_000]


def test_same_forest_on_another_machine(spark, prepared):
    """File packing and default parallelism of the session change nothing."""
    train = ft.complete_rows(prepared.filter("split = 'train'"))
    trees = []
    for size, parallelism in (("64k", "2"), ("128m", "16")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism)
        stored = write_table(train, scratch_uri(spark, "train"))
        vectors = tr.training_vectors(
            stored.repartition(int(parallelism)), ft.fit_features(stored), "date_time",
            [*FeatureSpec().inputs, "label", "fold"], SETTINGS)
        trees.append(_candidate("RandomForest").estimator.fit(vectors).toDebugString.split("\n")[1:])
        vectors.unpersist()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert trees[0] == trees[1] and len(trees[0]) > 100


def test_every_grid_runs(sets, spark):
    vectors, _, _ = sets
    for name, grid in (("LogisticRegression", {"regParam": [0.0, 0.5], "elasticNetParam": [0.0, 0.5]}),
                       ("RandomForest", {"numTrees": [2, 4], "maxDepth": [2, 5]})):
        settings = SETTINGS.tuned_over(name, **grid)
        rows = tr.cv_scores(spark, tr.cross_validate(
            tr.candidate(name, settings), vectors, settings, "fold")).collect()
        assert len(rows) == 4 and sum(r["is_best"] for r in rows) == 1
        assert all(set(r["params"]) == set(grid) for r in rows)


def test_importances_by_slot_and_by_source(sets, prepared):
    vectors, _, feature_model = sets
    fitted, _ = tr.fit_timed(_candidate("DecisionTree"), vectors, SETTINGS)
    slots = tr.importances(fitted, feature_model.transform(prepared))
    sources = tr.importances(fitted, feature_model.transform(prepared), by_source=True)
    assert sources.count() == 11
    assert slots.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    top = sources.orderBy(F.desc("importance")).first()
    assert top["feature"] == "hour"


def test_saved_model_scores_rows_without_label(spark, sets):
    vectors, test, feature_model = sets
    fitted, _ = tr.fit_timed(_candidate("DecisionTree"), vectors, SETTINGS)
    model = tr.full_model(feature_model, fitted)
    uri = tr.save_model(model, scratch_uri(spark, "tree"))
    columns = ["date_time", "predicted_level", "p_low", "p_medium", "p_high"]
    loaded = tr.score(test.drop("label", "congestion"), tr.load_model(uri)).select(columns)
    assert sorted(loaded.collect()) == sorted(tr.score(test, model).select(columns).collect())


def test_rows_with_missing_inputs_get_no_prediction(sets):
    vectors, test, feature_model = sets
    gap = test.withColumn("temp_c", F.when(F.hour("date_time") == 3, None).otherwise(F.col("temp_c")))
    for name in ("LogisticRegression", "DecisionTree"):
        fitted, _ = tr.fit_timed(_candidate(name), vectors, SETTINGS)
        scored = tr.score(gap, tr.full_model(feature_model, fitted))
        empty = scored.filter("predicted_level is null and p_low is null and prediction is null")
        assert empty.count() == gap.filter("temp_c is null").count() > 0


def test_cross_validation_keeps_the_best_depth(sets, spark):
    vectors, _, _ = sets
    tree = _candidate("DecisionTree")
    shallow = dataclasses.replace(tree, grid=[
        {tree.estimator.maxDepth: 1}, {tree.estimator.maxDepth: 6}])
    fitted = tr.cross_validate(shallow, vectors, SETTINGS, "fold")
    rows = tr.cv_scores(spark, fitted).orderBy("position").collect()
    assert [r["is_best"] for r in rows] == [False, True]
    assert rows[1]["params"] == {"maxDepth": "6"} and rows[1]["f1"] > rows[0]["f1"]
    tuned = dataclasses.replace(SETTINGS, tune=True)
    model, _ = tr.fit_timed(shallow, vectors, tuned, "fold")
    assert model.getOrDefault("maxDepth") == 6
