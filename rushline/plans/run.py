"""One complete run: clean, profile, label, train, evaluate, alert, log."""

from __future__ import annotations

from pyspark.ml.base import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rushline.operators import alerts as al
from rushline.operators import bins, charts
from rushline.operators import cleaning as cl
from rushline.operators import evaluation as ev
from rushline.operators import features as ft
from rushline.operators import profile as pr
from rushline.operators import search
from rushline.operators import split as sp
from rushline.operators import training as tr
from rushline.plans.report import write_profile
from rushline.sinks import KeyedTable, RunLog, write_csv, write_json, write_table
from rushline.sources import join_uri
from rushline.spec import LEVELS, FeatureSpec, ModelSettings, Spec

RESULT_SCHEMA = (
    "position int, model string, train_time_s double, accuracy double, precision double, "
    "recall double, f1 double, n_rows bigint, confusion_matrix array<array<bigint>>, "
    "feature_importances array<double>, parameters map<string,string>"
)
RESULT_KEYS = ("run", "position")
SAMPLE_COLUMNS = (
    "hour", "day_of_week", "is_weekend", "temp_c", "rain_1h", "snow_1h",
)


def prepare(df: DataFrame, spec: Spec = Spec(), settings: ModelSettings = ModelSettings()) -> DataFrame:
    """Calendar columns, level, label, split and fold; one projection over ``df``."""
    derived = cl.add_level(cl.add_derived(df, spec), spec)
    labelled = ft.add_label(derived)
    with_split = sp.add_split(labelled, spec.key, settings.train_share, settings.split_salt)
    return sp.add_fold(with_split, spec.key, settings.folds)


def processed_sample(df: DataFrame, spec: Spec = Spec(), n: int = 4000) -> DataFrame:
    """Twelve columns of ``n`` rows in hash order of the key, time as text."""
    return sp.sample_rows(df, spec.key, n).select(
        F.col(spec.time).cast("string").alias(spec.time),
        *SAMPLE_COLUMNS, spec.category, "season", "is_holiday", spec.measure, "congestion",
    )


def profile_only(raw: DataFrame, out: str, spec: Spec = Spec()) -> DataFrame:
    """Clean and profile, nothing else; returns the profile document.

    The cleaned rows are written first, so the dedupe shuffle runs once and not
    once per profile scan.
    """
    table = write_table(cl.clean(raw, spec), join_uri(out, "observations"))
    return write_profile(table, join_uri(out, "results"), spec)["document"]


def run(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    spec: Spec = Spec(),
    features: FeatureSpec = FeatureSpec(),
    settings: ModelSettings = ModelSettings(),
    source: str = "",
    log_uri: str | None = None,
    experiment: str = "congestion",
    n_alerts: int = 8,
    alerts_from: str = "prediction",
    with_charts: bool = True,
    run_key: str = "run",
    resume: bool = False,
) -> DataFrame:
    """Write every artifact of a run under ``out``; returns the one-row summary.

    With ``resume`` a run that broke goes on under its ``run_key``: models whose
    result row was written are loaded, not fitted again, and a tuned search keeps
    the folds it had finished. Without it earlier results of ``out`` are dropped.

    Alerts describe the best model's predictions; with ``alerts_from="level"``
    they describe the observed levels with constant shares. ``with_charts=False``
    leaves the chart tables out.

    The cleaned, labelled table is written once, partitioned by split, and
    everything after it reads those files: the dedupe shuffle runs once, scans
    prune columns and splits, and a lost executor costs a re-read only.
    """
    log = RunLog(spark, log_uri, experiment)
    log.start(source=source, out=out)

    def at(*parts: str) -> str:
        return join_uri(out, *parts)

    raw_columns = raw.columns
    table = write_table(
        prepare(cl.clean(raw, spec), spec, settings), at("observations"), ["split"])
    observed = table.select(*raw_columns)
    load = pr.load_summary(observed, spec.time, source)

    profile = write_profile(observed, at("results"), spec)
    log.record_profile(profile["document"].select(
        "row_count", "column_count",
        *[F.col(f"{spec.measure}_quantiles.{q}").alias(f"{spec.measure}_{q}")
          for q in ("p05", "p25", "p50", "p75", "p95")]))
    counts = write_table(pr.class_counts(table), at("results", "class_count_table"))
    write_csv(counts.orderBy("congestion"), at("results", "class_counts"), single_file=True)
    write_csv(processed_sample(table, spec), at("processed_sample"), single_file=True)

    test = table.filter(F.col("split") == "test")
    scores, weights = train_all(
        table, test, out, spec, features, settings, log, run_key, resume)
    results = read_results(spark, out, run_key)
    matrices = result_matrices(results)
    write_csv(
        results.orderBy("position").select("model", *ev.METRICS, "train_time_s"),
        at("results", "model_results_csv"), single_file=True)
    write_json(results.orderBy("position"), at("results", "model_results_json"), single_file=True)
    write_json(
        ev.per_class(matrices, by=["model"]).drop("hit").orderBy("model", "level"),
        at("results", "per_class_metrics"), single_file=True)

    best = ev.best_and_worst(results, order="position").first()["best"]
    predicted = alerts_from == "prediction"
    records = alert_sample(scores[best] if predicted else test, spec, n_alerts, predicted)
    write_json(records.orderBy("datetime"), at("results", "sample_alerts"), single_file=True)
    written = spark.read.schema(records.schema).json(at("results", "sample_alerts"))

    if with_charts:
        write_charts(table, profile, counts, results, matrices, weights, out, spec)

    log.finish()
    summary = run_summary(load, table, results, written, best, settings, log)
    write_json(summary, at("results", "run_summary"), single_file=True)
    return spark.read.schema(summary.schema).json(at("results", "run_summary"))


def write_charts(
    table: DataFrame, profile: dict[str, DataFrame], counts: DataFrame, results: DataFrame,
    matrices: DataFrame, weights: DataFrame | None, out: str, spec: Spec,
) -> None:
    """The nine chart tables."""
    bars = {
        "hourly": profile["profile_hourly_volume"].select("hour", "avg_volume").orderBy("hour"),
        "dow": charts.weekday_bars(profile["profile_dow_volume"]),
        "weather": charts.category_bars(profile["profile_weather_volume"], spec.category),
        "congestion": counts.orderBy("congestion"),
        "temp_vs_volume": bins.hexbin(table, "temp_c", spec.measure),
        "volume_histogram": bins.histogram(
            table, spec.measure, low_max=spec.low_max, high_min=spec.high_min),
        "model_comparison": ev.metrics_long(results.select("model", *ev.METRICS)),
        "confusion": ev.named_confusion(matrices, by=["model"]),
    }
    if weights is not None:  # only forests have them
        bars["feature_importance"] = charts.importance_bars(weights)
    for name, chart in bars.items():
        write_csv(chart, join_uri(out, "charts", name))


def train_all(
    table: DataFrame, test: DataFrame, out: str, spec: Spec, features: FeatureSpec,
    settings: ModelSettings, log: RunLog, run_key: str = "run", resume: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Fit, save, score and evaluate every candidate.

    Returns the scored test rows of each model and the forest's importances. The
    test rows are scored once per model, into a table that metrics and alerts
    read. A model's row is put into the results as soon as it is evaluated, as the
    last thing written of it; a run resumed under the same key fits only models
    without a row, and putting a row again replaces it.
    """
    spark = table.sparkSession
    train = ft.complete_rows(table.filter(F.col("split") == "train"), features)
    feature_model = ft.fit_features(train, features)
    vectors = tr.training_vectors(
        train, feature_model, spec.key, [*features.inputs, "label", "fold"], settings)
    kept = dict.fromkeys([
        spec.key, spec.time, "hour", "day_of_week", spec.category, spec.detail, "temp_c",
        spec.holiday, "congestion", "label", "prediction", "predicted_level",
        *(f"p_{name}" for name in LEVELS)])

    table_of_results = results_table(spark, out)
    cells = search.cells_table(spark, join_uri(out, "results", "search"))
    if not resume:
        table_of_results.clear()
        cells.clear()
    finished = {(r["position"], r["model"]) for r in read_results(spark, out, run_key).collect()}
    scores, weights = {}, None
    for position, candidate in enumerate(tr.candidates(settings)):
        name = candidate.name.lower()
        model_uri, score_uri = join_uri(out, "models", name), join_uri(out, "scores", name)
        if (position, candidate.name) in finished:
            fitted = tr.load_model(model_uri).stages[-1]
            scored = spark.read.parquet(score_uri)
        else:
            fitted, seconds = tr.timed(lambda c=candidate: tuned(c, vectors, settings, cells, run_key))
            model = tr.full_model(feature_model, fitted)
            tr.save_model(model, model_uri)
            scored = write_table(
                tr.score(test, model, features.scalars).select(*kept), score_uri)
            row = tr.result_row(position, candidate.name, seconds, fitted, scored)
            table_of_results.put(row.withColumn("run", F.lit(run_key)))
            log.record_results(
                read_results(spark, out, run_key).filter(F.col("position") == position))
        scores[candidate.name] = scored
        if candidate.name == "RandomForest":
            weights = tr.importances(fitted, vectors, features)
    vectors.unpersist()
    return scores, weights


def tuned(candidate: tr.Candidate, vectors: DataFrame, settings: ModelSettings,
          cells: KeyedTable, run_key: str) -> Model:
    """The candidate fitted on all training rows, with the best of its grid if asked for."""
    if settings.tune:
        chosen, _ = search.tuned_models([candidate], vectors, settings, cells, run_key)
        candidate = chosen[candidate.name]
    return candidate.estimator.fit(vectors)


def results_table(spark: SparkSession, out: str) -> KeyedTable:
    return KeyedTable(spark, join_uri(out, "results", "model_results"),
                      f"run string, {RESULT_SCHEMA}", RESULT_KEYS)


def read_results(spark: SparkSession, out: str, run_key: str = "run") -> DataFrame:
    """The results of a run, one row per finished model."""
    return results_table(spark, out).read().where(F.col("run") == run_key).drop("run")


def alert_sample(rows: DataFrame, spec: Spec, n: int, predicted: bool) -> DataFrame:
    """Alert records of one row per stratum of scored rows, or of observed ones."""
    if predicted:
        level = "predicted_level"
        rows = rows.filter(F.col(level).isNotNull())
    else:
        level = "congestion"
        rows = al.constant_shares(rows, level)
    return al.alert_records(al.contexts(al.alert_rows(rows, spec, level, n), spec, level))


def result_matrices(results: DataFrame) -> DataFrame:
    """The matrices of a results table as (model, label, prediction, n)."""
    return (
        results.select("model", F.posexplode("confusion_matrix").alias("label", "cells"))
        .select("model", "label", F.posexplode("cells").alias("prediction", "n"))
    )


def run_summary(load: DataFrame, table: DataFrame, results: DataFrame, alerts: DataFrame,
                best: str, settings: ModelSettings, log: RunLog) -> DataFrame:
    """One nested row: load figures, model results, split sizes and settings."""
    sizes = table.agg(
        F.struct(
            F.count_if(F.col("split") == "train").alias("train"),
            F.count_if(F.col("split") == "test").alias("test"),
        )
    ).scalar()
    models = results.agg(
        # one element per trained model
        F.array_sort(
            F.collect_list(F.struct(*results.columns)),
            lambda a, b: a.getField("position") - b.getField("position"),
        )
    ).scalar()
    return load.select(
        F.struct(*load.columns).alias("load"),
        models.alias("model_results"),
        F.lit(best).alias("best_model"),
        sizes.getField("train").alias("train_rows"),
        sizes.getField("test").alias("test_rows"),
        alerts.agg(F.count(F.lit(1))).scalar().alias("n_sample_alerts"),
        F.lit(log.run_id).alias("run_id"),
        F.lit(log.uri).alias("run_log"),
        F.lit(settings.tune).alias("cross_validation"),
        F.to_json(F.create_map(*[
            F.lit(str(x)) for pair in vars(settings).items() for x in pair
        ])).alias("settings"),
    )
