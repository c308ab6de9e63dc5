"""K1-K11 and a complete run."""

import json

import pytest
from pyspark.sql import functions as F

from rushline.plans import run
from rushline.plans.run import alert_sample
from rushline.sinks import RunLog, scratch_uri, write_csv, write_json, write_table
from rushline.spec import FeatureSpec, ModelSettings, Spec
from tests.data import hourly_table

SETTINGS = ModelSettings().fitted_with("LogisticRegression", maxIter=10).fitted_with(
    "RandomForest", numTrees=4, maxDepth=5)


def _json(folder):
    return [json.loads(line) for f in sorted(folder.glob("part-*.json"))
            for line in f.read_text().splitlines()]


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("run")
    raw = hourly_table(spark, 2_000).unionByName(hourly_table(spark, 100))
    summary = run(spark, raw, str(out / "out"), settings=SETTINGS, source="made by rule",
                  log_uri=str(out / "log"))
    return out, summary.first()


def test_summary(finished):
    _, row = finished
    assert row["load"]["rows"] == 2_000 and row["load"]["columns"] == 9
    assert row["load"]["source"] == "made by rule"
    assert row["train_rows"] + row["test_rows"] == 2_000
    assert [m["model"] for m in row["model_results"]] == [
        "LogisticRegression", "DecisionTree", "RandomForest"]
    assert row["cross_validation"] is False and row["n_sample_alerts"] == 8


def test_tables_and_samples(finished):
    out, _ = finished
    results = out / "out" / "results"
    counts = (next((results / "class_counts").glob("part-*.csv"))).read_text().splitlines()
    assert counts[0] == "congestion,count" and [c.split(",")[0] for c in counts[1:]] == [
        "high", "low", "medium"]
    assert sum(int(c.split(",")[1]) for c in counts[1:]) == 2_000
    sample = (next((out / "out" / "processed_sample").glob("part-*.csv"))).read_text().splitlines()
    assert sample[0] == ("date_time,hour,day_of_week,is_weekend,temp_c,rain_1h,snow_1h,"
                         "weather_main,season,is_holiday,traffic_volume,congestion")
    assert len(sample) == 2_001
    models = (next((results / "model_results_csv").glob("part-*.csv"))).read_text().splitlines()
    assert models[0] == "model,accuracy,precision,recall,f1,train_time_s" and len(models) == 4
    assert len(_json(results / "per_class_metrics")) == 9


def test_alerts(finished):
    out, _ = finished
    alerts = _json(out / "out" / "results" / "sample_alerts")
    assert len(alerts) == 8
    for alert in alerts:
        assert alert["predicted_level"] == alert["context"]["level"]
        shares = [alert["context"][f"p_{x}"] for x in ("low", "medium", "high")]
        assert sum(shares) == pytest.approx(1)
        assert f"around {alert['context']['hour']:02d}:00" in alert["alert"]


def test_alerts_of_observed_levels(spark, finished):
    out, _ = finished
    table = spark.read.parquet(str(out / "out" / "observations")).filter("split = 'test'")
    rows = alert_sample(table, Spec(), 8, predicted=False).collect()
    assert len(rows) == 8
    for row in rows:
        assert row["context"][f"p_{row['predicted_level']}"] == 0.8
        assert "(model confidence ~80%)" in row["alert"]


def test_charts(finished):
    out, _ = finished
    charts = out / "out" / "charts"
    rows = {p.name: sum(len(f.read_text().splitlines()) - 1 for f in p.glob("part-*.csv")
                        if f.stat().st_size) for p in charts.iterdir()}
    assert rows["hourly"] == 24 and rows["dow"] == 7 and rows["congestion"] == 3
    assert rows["weather"] == 7 and rows["model_comparison"] == 12 and rows["confusion"] == 27
    assert rows["volume_histogram"] == 50 and rows["feature_importance"] == 9 + 7 + 2
    assert rows["temp_vs_volume"] > 10


def test_run_with_its_options(spark, tmp_path):
    """Tuned fits, another split, whole-day holidays, a wide category, no charts."""
    raw = hourly_table(spark, 1_500).withColumns({
        "weather_description": F.concat(F.lit("w"), F.unix_timestamp("date_time")),
        "holiday": F.when(F.date_format("date_time", "MM-dd HH") == "11-22 00", "Thanksgiving Day")
        .when(F.hour("date_time") > 3, "None")})
    settings = ModelSettings(
        tune=True, split_salt="again", train_share=0.705, partitions=3,
        grids={"LogisticRegression": {"regParam": [0.0, 0.1]}, "DecisionTree": {"maxDepth": [2, 5]},
               "RandomForest": {"numTrees": [2, 3]}})
    spec = Spec(category="weather_description", null_is_holiday=False, whole_day_holidays=True)
    features = FeatureSpec(categories=("season",))
    row = run(spark, raw, str(tmp_path), spec, features, settings, with_charts=False,
              alerts_from="level").first()
    assert row["cross_validation"] is True and row["n_sample_alerts"] == 8
    assert abs(row["train_rows"] / 1_500 - 0.705) < 0.04
    assert not (tmp_path / "charts").exists()
    holidays = spark.read.parquet(str(tmp_path / "observations")).filter("is_holiday = 1")
    assert holidays.count() == 24
    assert spark.read.option("header", True).csv(
        str(tmp_path / "results" / "profile_weather_volume")).count() == 1_500


def test_run_log(spark, finished):
    out, row = finished
    logged = RunLog.runs(spark, str(out / "log")).first()
    assert logged["run_id"] == row["run_id"]
    assert logged["models"] == ["DecisionTree", "LogisticRegression", "RandomForest"]
    assert logged["settings"]["source"] == "made by rule"
    assert logged["profile_summary"]["row_count"] == 2_000
    assert logged["started_at"] <= logged["finished_at"]


def test_run_log_without_uri_writes_nothing(spark):
    log = RunLog(spark, None, "unit")
    log.start()
    log.record_model("m", {"maxIter": 50}, {"f1": 0.5})
    assert log.finish() is None


def test_run_log_event_payload(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), "unit-test")
    log.start(mode="table")
    log.record_profile(spark.sql("select 1000L as row_count, 9 as column_count, 3000.0D as p50"))
    log.record_model("RandomForest", {"numTrees": 120, "maxDepth": 15},
                     {"accuracy": 0.93, "f1": 0.92})
    uri = log.finish()
    row = RunLog.runs(spark, uri).first()
    assert row["experiment"] == "unit-test" and row["models"] == ["RandomForest"]
    assert row["profile_summary"]["p50"] == 3000.0
    event = spark.read.parquet(uri).filter("kind = 'model'").first()
    assert event["params"]["numTrees"] == "120" and event["metrics"]["f1"] == 0.92


def test_writers_replace_their_target(spark, tmp_path):
    df = spark.range(10)
    for _ in range(2):
        write_csv(df, str(tmp_path / "c"), single_file=True)
        write_json(df, str(tmp_path / "j"))
        table = write_table(df.withColumn("p", F.col("id") % 2), str(tmp_path / "t"), ["p"])
    assert len(list((tmp_path / "c").glob("part-*.csv"))) == 1
    assert spark.read.json(str(tmp_path / "j")).count() == 10
    plan = table.filter("p = 1")._jdf.queryExecution().toString()
    assert table.count() == 10 and "PartitionFilters: [isnotnull(p" in plan


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_uri(spark, "x"), scratch_uri(spark, "x")
    assert first.startswith(base) and first != second
