"""

The operators are bound to the bundled tables here. ``events`` doubles as an
observation table: one sensor row per event, with weather, holiday and
temperature columns made from the event's own fields (``observations``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import ORACLES  # noqa: E402
from rushline.functions import calendar as cal  # noqa: E402
from rushline.functions import text  # noqa: E402
from rushline.operators import alerts as al  # noqa: E402
from rushline.operators import bins, charts, quantiles  # noqa: E402
from rushline.operators import cleaning as cl  # noqa: E402
from rushline.operators import evaluation as ev  # noqa: E402
from rushline.operators import features as ft  # noqa: E402
from rushline.operators import profile as pr  # noqa: E402
from rushline.operators import search, sketches  # noqa: E402
from rushline.operators import split as sp  # noqa: E402
from rushline.operators import training as tr  # noqa: E402
from rushline.plans import report  # noqa: E402
from rushline.plans.run import (  # noqa: E402
    alert_sample, prepare, processed_sample, read_results, run_summary, train_all,
)
from rushline.sinks import RunLog, scratch_uri, write_csv, write_json, write_table  # noqa: E402
from rushline.sources import (  # noqa: E402
    RAW_SCHEMA, first_available, mount, read_document_paths, read_observations, read_report_csv,
)
from rushline.spec import (  # noqa: E402
    LEVEL_INDEX, QUANTILE_PROBS, FeatureSpec, ModelSettings, Spec,
)

try:  # the training-data operators are optional: their folder may be absent
    from rushline.llm import queries as llm  # noqa: E402
except ImportError as absent:
    if absent.name not in ("rushline.llm", "corpus_pipeline"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

OBSERVED = Spec(split_key="event_id")
# Hourly averages of events.value lie close to 50: these bounds part them.
BASELINE_BOUNDS = (49.0, 50.0)
QUANTITY_BOUNDS = (15.0, 35.0)
# Weather standing in for each event type.
WEATHER_OF = {
    "view": "Clear", "click": "Rain", "signup": "Snow", "error": "Fog", "purchase": "Clouds",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --------------------------------------------------------------------------
# Observation table over events
# --------------------------------------------------------------------------

def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw observations; the volume follows the event's value."""
    weather = F.create_map(*[F.lit(x) for pair in WEATHER_OF.items() for x in pair])
    main = weather[F.col("event_type")]
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.dayofmonth("ts") == 1, "New Years Day").otherwise("None").alias("holiday"),
        (F.col("value") / 8 + 270).alias("temp"),
        (F.col("value") / 64).alias("rain_1h"),
        F.when(F.col("event_type") == "signup", F.col("value") / 128).otherwise(0.0)
        .alias("snow_1h"),
        (F.col("event_id") % 101).cast("int").alias("clouds_all"),
        main.alias("weather_main"),
        F.concat(F.lower(main), F.lit(" conditions")).alias("weather_description"),
        F.col("ts").alias("date_time"),
        F.floor(F.col("value") * 40).cast("int").alias("traffic_volume"),
    )



def hourly_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared observations whose volume is 200 per hour of day.

    The level is then a known function of the features, so a trained model can
    be compared with the rule itself.
    """
    ruled = observations(spark, sf_dir).withColumn("traffic_volume", F.hour("date_time") * 200)
    return prepare(ruled, OBSERVED)


# --------------------------------------------------------------------------
# Profiles
# --------------------------------------------------------------------------

def hourly_profile(spark, sf_dir):
    return _rounded(
        pr.hourly_profile(_table(spark, sf_dir, "events"), "ts", "value"), "avg_volume")


def dow_profile(spark, sf_dir):
    return _rounded(
        pr.weekday_profile(_table(spark, sf_dir, "events"), "ts", "value"), "avg_volume")


def monthly_profile(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return _rounded(pr.monthly_profile(orders, "o_orderdate", "o_totalprice"), "avg_volume")


def category_profile(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return _rounded(
        pr.category_profile(orders, "o_orderpriority", "o_totalprice"), "avg_volume")


def text_category_profile(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return _rounded(pr.category_profile(documents, "lang", "n_chars"), "avg_volume")


def category_topn(spark, sf_dir):
    return pr.category_counts(_table(spark, sf_dir, "part"), "p_type", 20)


def category_topn_many(spark, sf_dir):
    return pr.category_counts(_table(spark, sf_dir, "orders"), "o_custkey", 20)


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def numeric_summary(spark, sf_dir):
    return _rounded(
        pr.numeric_summary(_table(spark, sf_dir, "lineitem"), NUMERIC), "mean", "stddev")


def null_audit(spark, sf_dir):
    """Documents beside their labels: most have none."""
    joined = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(
        _table(spark, sf_dir, "labels"), "doc_id", "left")
    return pr.null_counts(joined)


def quantiles_exact(spark, sf_dir):
    found = quantiles.exact_quantiles(_table(spark, sf_dir, "events"), "value")
    return _rounded(found, "value")


def quantiles_exact_lineitem(spark, sf_dir):
    found = quantiles.exact_quantiles(
        _table(spark, sf_dir, "lineitem"), "l_extendedprice", (0.0, 0.01, 0.5, 0.999, 1.0))
    return _rounded(found, "value")


SKETCHED = ("l_extendedprice", "l_quantity")
RANK_ERROR = 0.001


def quantiles_approx(spark, sf_dir):
    """Whether each sketched quantile's rank, counted over the whole column, is within
    the promised error of its probability."""
    rows = _table(spark, sf_dir, "lineitem")
    found = pr.approx_quantiles(rows, SKETCHED, relative_error=RANK_ERROR)
    wanted = [(c, p) for c in SKETCHED for p in QUANTILE_PROBS]
    values = found.agg(*[
        F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value"))).alias(f"v{i}")
        for i, (c, p) in enumerate(wanted)])
    value = [values.select(f"v{i}").scalar() for i in range(len(wanted))]
    ranked = rows.agg(F.count(F.lit(1)).alias("n"), *[
        x for i, (c, _) in enumerate(wanted)
        for x in (F.count_if(F.col(c) < value[i]).alias(f"lt{i}"),
                  F.count_if(F.col(c) <= value[i]).alias(f"le{i}"))])
    slack = F.lit(2 * RANK_ERROR) * F.col("n") + 1
    return ranked.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"),
                 ((F.col(f"lt{i}") <= p * F.col("n") + slack)
                  & (F.col(f"le{i}") >= p * F.col("n") - slack)).alias("within"))
        for i, (c, p) in enumerate(wanted)])))


def load_summary(spark, sf_dir):
    return pr.load_summary(_table(spark, sf_dir, "orders"), "o_orderdate", "orders")


def profile_suite(spark, sf_dir):
    suite = pr.profile_suite(
        observations(spark, sf_dir), "date_time", "traffic_volume", ["weather_main", "holiday"])
    return _rounded(suite, "avg_volume")


def profile_categories_wide(spark, sf_dir):
    """A category with a value for every few rows beside a narrow one."""
    suite = pr.profile_suite(
        _table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice",
        ["o_custkey", "o_orderstatus"])
    return _rounded(suite, "avg_volume", digits=1)


def profile_document(spark, sf_dir):
    """The profile of all observations in long form: a row per figure."""
    rows = observations(spark, sf_dir)
    totals = pr.table_totals(rows, OBSERVED.numeric, [OBSERVED.measure, OBSERVED.temp])
    cells = pr.profile_cells(
        rows, OBSERVED.time, OBSERVED.measure, [OBSERVED.category, OBSERVED.holiday])
    hourly = pr.hourly_profile(rows, OBSERVED.time, OBSERVED.measure)
    return _rounded(
        report.profile_rows(totals, report.profile_tables(totals, cells, hourly, OBSERVED)), "value")


def describe_text(spark, sf_dir):
    """Statistics laid out as text; those that do not depend on the order of a sum."""
    laid_out = pr.describe_text(_table(spark, sf_dir, "part"), ["p_size", "p_retailprice"])
    return laid_out.filter(F.col("summary").isin("count", "min", "max"))


def dow_chart(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return _rounded(charts.weekday_bars(pr.weekday_profile(events, "ts", "value")), "avg_volume")


def category_chart(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return _rounded(charts.category_bars(
        pr.category_profile(events, "event_type", "value"), "event_type"), "avg_volume")


# --------------------------------------------------------------------------
# Cleaning, calendar, level
# --------------------------------------------------------------------------

def _hourly_events(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        F.date_format(F.date_trunc("hour", "ts"), pr.TIME_FORMAT).alias("hour_start"),
        "value", "event_id", "user_id", "event_type",
    )


HOURLY_EVENTS = Spec(time="hour_start", temp="value", min_temp=1)


def clean_observations(spark, sf_dir):
    return cl.clean(_hourly_events(spark, sf_dir), HOURLY_EVENTS, ["value", "event_id"])


def clean_filter_first(spark, sf_dir):
    return cl.clean(
        _hourly_events(spark, sf_dir), HOURLY_EVENTS, ["value", "event_id"], filter_first=True)


def distinct_customers(spark, sf_dir):
    """Cheapest order of every customer, ties to the lowest key."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_totalprice", "o_orderkey", "o_orderpriority")
    return cl.distinct_on(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"])


def calendar_features(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("date_time"),
        F.when(F.col("o_orderstatus") == "F", "None")
        .when(F.col("o_orderstatus") == "O", "Labor Day").alias("holiday"),
        (F.col("o_totalprice") / 1024).alias("temp"),
    )
    return cl.add_calendar(orders).drop("date_time", "temp")


def hour_buckets(spark, sf_dir):
    hour = F.hour("ts")
    return _table(spark, sf_dir, "events").select(
        "event_id", hour.alias("hour"), cal.hour_bucket(hour).alias("hour_bucket"),
        F.date_format("ts", pr.TIME_FORMAT).alias("time_text"), text.clock(hour).alias("clock"))


def day_name(spark, sf_dir):
    day = F.dayofweek("ts")
    return _table(spark, sf_dir, "events").groupBy(
        day.alias("day_of_week"), cal.day_name(day).alias("day_name")
    ).agg(F.count(F.lit(1)).alias("n"))


def holiday_null_rule(spark, sf_dir):
    """A NULL holiday is none, and a holiday row marks its whole day."""
    spec = Spec(null_is_holiday=False, whole_day_holidays=True)
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("date_time"),
        F.when(F.col("o_orderkey") % 997 == 0, "Labor Day")
        .when(F.col("o_orderstatus") == "F", "None").alias("holiday"),
        F.lit(290.0).alias("temp"))
    return cl.add_derived(orders, spec).select("o_orderkey", "is_holiday")


def holiday_days(spark, sf_dir):
    """Any row at midnight of the first marks its whole day."""
    marked = _table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("date_time"),
        F.when((F.hour("ts") == 0) & (F.dayofmonth("ts") % 7 == 1), "Labor Day")
        .otherwise("None").alias("holiday"))
    return cl.spread_holidays(marked).groupBy(
        F.date_format("date_time", "yyyy-MM-dd").alias("day"), "is_holiday"
    ).agg(F.count(F.lit(1)).alias("n"))


def null_defaults(spark, sf_dir):
    """NULL and empty alert inputs get their defaults."""
    events = _table(spark, sf_dir, "events")
    gaps = F.col("event_id") % 3
    return events.select(
        "event_id",
        F.when(gaps == 0, F.col("event_type")).when(gaps == 1, "").alias("weather_main"),
        F.when(gaps == 1, F.col("props")).alias("weather_description"),
        F.when(gaps == 2, F.col("value")).alias("temp_c"),
        F.when(gaps == 2, "").when(gaps == 1, "Labor Day").alias("holiday"),
        F.hour("ts").alias("hour"),
        F.when(gaps != 0, F.dayofweek("ts")).alias("day_of_week"),
        F.lit("low").alias("congestion"),
    ).transform(al.contexts).select(
        "event_id", "weather_main", "weather_description", "temp_c", "holiday", "day_name")


QUANTITY = Spec(measure="l_quantity", low_max=QUANTITY_BOUNDS[0], high_min=QUANTITY_BOUNDS[1])


def congestion_label(spark, sf_dir):
    return cl.add_level(
        _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
        QUANTITY)


def class_counts(spark, sf_dir):
    return pr.class_counts(
        cl.add_level(_table(spark, sf_dir, "lineitem").select("l_quantity"), QUANTITY))


# --------------------------------------------------------------------------
# Samples, split, encoding
# --------------------------------------------------------------------------

def stratified_pick(spark, sf_dir):
    rows = al.alert_rows(
        prepare(observations(spark, sf_dir), OBSERVED), prefer=("date_time", "event_id"))
    return rows.select("event_id", "datetime", "hour_bucket", "congestion", "weather_main")


def deterministic_sample(spark, sf_dir):
    rows = sp.sample_rows(_table(spark, sf_dir, "events"), "event_id", 4000)
    return rows.select("event_id", F.col("ts").cast("date").cast("string").alias("day"), "value")


def processed_rows(spark, sf_dir):
    """The twelve-column sample over observations, hash order of the event."""
    return processed_sample(prepare(observations(spark, sf_dir), OBSERVED), OBSERVED)


def hash_split_counts(spark, sf_dir):
    return sp.split_counts(sp.add_split(_table(spark, sf_dir, "events"), "event_id"))


def hash_split_seeded(spark, sf_dir):
    """Another draw of the split, with a share of no whole percent."""
    split = sp.add_split(_table(spark, sf_dir, "events"), "event_id", 0.855, "second")
    return split.select("event_id", "split")


def hash_folds(spark, sf_dir):
    return sp.add_fold(_table(spark, sf_dir, "orders"), "o_orderkey", 3).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"))


def category_index(spark, sf_dir):
    return ft.category_index(_table(spark, sf_dir, "events"), "event_type")


def category_index_wide(spark, sf_dir):
    return ft.category_index(_table(spark, sf_dir, "orders"), "o_custkey")


def label_index(spark, sf_dir):
    labelled = ft.add_label(
        cl.add_level(_table(spark, sf_dir, "lineitem").select("l_quantity"), QUANTITY))
    return labelled.groupBy("congestion", "label").agg(F.count(F.lit(1)).alias("n"))


def one_hot_flat(spark, sf_dir):
    """The one-hot slots of the event type as columns, with the index they come from."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    spec = FeatureSpec(scalars=(), categories=("event_type",))
    encoded = ft.fit_features(events, spec).transform(events)
    slots = vector_to_array("event_type_vec")
    names = ft.slot_names(encoded)
    return encoded.select(
        "event_id", F.col("event_type_idx").alias("event_type_idx"),
        *[F.get(slots, F.lit(i)).alias(n.removeprefix("event_type_vec_"))
          for i, n in enumerate(names)])


def assembled_features(spark, sf_dir):
    """Every slot of the feature vector as a column, for every observation."""
    rows = prepare(observations(spark, sf_dir), OBSERVED)
    built = ft.fit_features(rows).transform(rows)
    slots = vector_to_array("features")
    return built.select("event_id", *[
        F.get(slots, F.lit(i)).alias(name.lower())
        for i, name in enumerate(ft.slot_names(built))
    ])


# --------------------------------------------------------------------------
# Bins
# --------------------------------------------------------------------------

def histogram50(spark, sf_dir):
    table = bins.histogram(
        _table(spark, sf_dir, "events"), "value", 50, low_max=20.0, high_min=100.0)
    return _rounded(table, "lower", "upper")


def hexbin40(spark, sf_dir):
    table = bins.hexbin(_table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 40)
    return _rounded(table, "center_x", "center_y")


# --------------------------------------------------------------------------
# Evaluation: the average of a row's hour (or hour and weekday) as prediction
# --------------------------------------------------------------------------

def baseline_predictions(spark, sf_dir):
    """(model, label, prediction): two rule baselines over all events."""
    events = _table(spark, sf_dir, "events").select(
        F.hour("ts").alias("hour"), F.dayofweek("ts").alias("dow"), "value")

    def as_label(measure):
        return cal.level_index(
            cal.level(measure, *BASELINE_BOUNDS), ft.LEVEL_INDEX).cast("int")

    # One cell per hour and weekday, at most 168 rows: the hour averages are
    # taken over the cells, and the whole table is small enough to broadcast.
    cells = events.groupBy("hour", "dow").agg(F.sum("value").alias("s"), F.count("value").alias("n"))
    hour = Window.partitionBy("hour")
    means = cells.select(
        "hour", "dow",
        F.round(F.sum("s").over(hour) / F.sum("n").over(hour), 6).alias("hour_mean"),
        F.round(F.col("s") / F.col("n"), 6).alias("cell_mean"),
    )
    joined = events.join(F.broadcast(means), ["hour", "dow"])
    models = F.array(
        F.struct(F.lit("hour_mean").alias("model"), as_label(F.col("hour_mean")).alias("prediction")),
        F.struct(F.lit("hour_dow_mean").alias("model"),
                 as_label(F.col("cell_mean")).alias("prediction")),
    )
    return joined.select(as_label(F.col("value")).alias("label"), F.inline(models))


def confusion_dense(spark, sf_dir):
    return ev.confusion(baseline_predictions(spark, sf_dir), by=["model"])


def confusion_named(spark, sf_dir):
    return ev.named_confusion(confusion_dense(spark, sf_dir), by=["model"])


def weighted_metrics(spark, sf_dir):
    return _rounded(
        ev.weighted_metrics(confusion_dense(spark, sf_dir), by=["model"]), *ev.METRICS)


def per_class_metrics(spark, sf_dir):
    classes = ev.per_class(confusion_dense(spark, sf_dir), by=["model"])
    return _rounded(classes.drop("hit"), "precision", "recall", "f1")


def metrics_long(spark, sf_dir):
    results = ev.weighted_metrics(confusion_dense(spark, sf_dir), by=["model"])
    return _rounded(ev.metrics_long(results.drop("n_rows")), "value")


def best_worst_model(spark, sf_dir):
    results = ev.weighted_metrics(confusion_dense(spark, sf_dir), by=["model"])
    return _rounded(ev.best_and_worst(results), "f1_gap_points")


def model_gap(spark, sf_dir):
    results = ev.weighted_metrics(confusion_dense(spark, sf_dir), by=["model"])
    return _rounded(ev.model_gap(results, "hour_mean", "hour_dow_mean"), "gap_points")


def best_recall_range(spark, sf_dir):
    classes = ev.per_class(confusion_dense(spark, sf_dir), by=["model"])
    return _rounded(ev.recall_range(classes), "min_recall", "max_recall")


# --------------------------------------------------------------------------
# Alerts
# --------------------------------------------------------------------------

def _event_contexts(spark, sf_dir):
    rows = al.constant_shares(prepare(observations(spark, sf_dir), OBSERVED))
    return al.contexts(rows)


def alert_text(spark, sf_dir):
    return _event_contexts(spark, sf_dir).select("event_id", al.alert_text().alias("alert"))


def prompt_table(spark, sf_dir):
    return _event_contexts(spark, sf_dir).select("event_id", al.prompt_text().alias("prompt"))


def request_bodies(spark, sf_dir):
    return _event_contexts(spark, sf_dir).select(
        "event_id", al.request_body(al.prompt_text()).alias("body"))


def response_parse(spark, sf_dir):
    """A response of three blocks per event, one of them without text."""
    body = F.concat(
        F.lit('{"id":"r","content":[{"type":"text","text":"  About "},{"type":"tool"},'
              '{"type":"text","text":"'), F.col("event_type"),
        F.lit(' today.\\n "}]}'))
    return _table(spark, sf_dir, "events").select(
        "event_id", al.response_text(body).alias("reply"))


def adhoc_alerts(spark, sf_dir):
    """Contexts that give a level and an hour only."""
    hour = F.hour("ts")
    asked = _table(spark, sf_dir, "events").select(
        "event_id", hour.alias("hour"), cal.level(hour, 7, 17).alias("level"))
    return al.with_defaults(asked).select("event_id", al.alert_text().alias("alert"))


# --------------------------------------------------------------------------
# Training on levels that follow a rule
# --------------------------------------------------------------------------

SETTINGS = ModelSettings()


def cell_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared observations whose level needs hour, weekend and weather together.

    Every 17th event has no temperature, so no model may predict it.
    """
    weekend = F.dayofweek("date_time").isin(1, 7).cast("int")
    rain = (F.col("weather_main") == "Rain").cast("int")
    ruled = observations(spark, sf_dir).withColumns({
        "traffic_volume": F.hour("date_time") * 150 + weekend * 800 + rain * 600,
        "temp": F.when(F.col("event_id") % 17 != 0, F.col("temp")),
    })
    return prepare(ruled, OBSERVED)


def _training_set(rows, features=FeatureSpec(), folds=("fold",)):
    """(test rows, fitted feature stages, kept training vectors) of prepared rows."""
    train = ft.complete_rows(rows.filter(F.col("split") == "train"), features)
    feature_model = ft.fit_features(train, features)
    vectors = tr.training_vectors(
        train, feature_model, "event_id", [*features.inputs, "label", *folds])
    return rows.filter(F.col("split") == "test"), feature_model, vectors


def _trained(rows, name):
    """(test rows, fitted classifier, full model, vectors) for one classifier."""
    test, feature_model, vectors = _training_set(rows)
    fitted, _ = tr.fit_timed(tr.candidate(name, SETTINGS), vectors, SETTINGS)
    vectors.unpersist()
    return test, fitted, tr.full_model(feature_model, fitted), vectors


def _score_counts(rows, name):
    test, _, model, _ = _trained(rows, name)
    return tr.score(test, model).groupBy("congestion", "predicted_level").agg(
        F.count(F.lit(1)).alias("n"))


def lr_scores(spark, sf_dir):
    return _score_counts(hourly_rule(spark, sf_dir), "LogisticRegression")


def dt_scores(spark, sf_dir):
    return _score_counts(cell_rule(spark, sf_dir), "DecisionTree")


def rf_scores(spark, sf_dir):
    return _score_counts(hourly_rule(spark, sf_dir), "RandomForest")


def saved_model_scores(spark, sf_dir):
    """Save the whole model, load it, score rows that carry no label."""
    test, _, model, _ = _trained(cell_rule(spark, sf_dir), "DecisionTree")
    uri = tr.save_model(model, scratch_uri(spark, "decisiontree"))
    unlabelled = test.drop("label", "congestion", "traffic_volume")
    return tr.score(unlabelled, tr.load_model(uri)).groupBy("predicted_level").agg(
        F.count(F.lit(1)).alias("n"))


def predicted_alerts(spark, sf_dir):
    """Alerts from model predictions and probabilities, for every predicted test row."""
    test, _, model, _ = _trained(cell_rule(spark, sf_dir), "DecisionTree")
    predicted = tr.score(test, model).filter(F.col("predicted_level").isNotNull())
    return al.contexts(predicted, level="predicted_level").select(
        "event_id", al.alert_text().alias("alert"))


def importances(spark, sf_dir):
    """The slots of a forest on the hourly rule: which is first, and the sum of all."""
    _, fitted, _, vectors = _trained(hourly_rule(spark, sf_dir), "RandomForest")
    bars = charts.importance_bars(tr.importances(fitted, vectors))
    first = bars.agg(F.max_by("feature", "importance")).scalar()
    total = bars.agg(F.round(F.sum("importance"), 6)).scalar()
    return bars.select(
        F.lower("feature").alias("feature"), (F.col("feature") == first).alias("is_top"),
        total.alias("total"))


def importances_by_source(spark, sf_dir):
    _, fitted, _, vectors = _trained(hourly_rule(spark, sf_dir), "DecisionTree")
    return _rounded(charts.importance_bars(
        tr.importances(fitted, vectors, by_source=True)), "importance")


def model_results(spark, sf_dir):
    """All three models on the level of the events' own values: the figures of each
    result row that follow from the rows, and whether its metrics follow from its matrix."""
    features = FeatureSpec(scalars=("hour", "day_of_week", "is_weekend", "clouds_all"))
    test, feature_model, vectors = _training_set(
        prepare(observations(spark, sf_dir), OBSERVED), features, folds=())
    table = None
    for position, candidate in enumerate(tr.candidates(SETTINGS)):
        fitted, seconds = tr.fit_timed(candidate, vectors, SETTINGS)
        scored = tr.score(test, tr.full_model(feature_model, fitted), features.scalars)
        row = tr.result_row(position, candidate.name, seconds, fitted, scored)
        table = row if table is None else table.unionByName(row)
    vectors.unpersist()
    matrix = F.col("confusion_matrix")

    def total(cells):
        return F.aggregate(cells, F.lit(0).cast("long"), lambda a, x: a + x)

    hits = sum((matrix[i][i] for i in range(1, 3)), matrix[0][0])
    return table.select(
        "position", "model", "n_rows",
        *[total(matrix[i]).alias(f"support_{name}") for i, name in enumerate(LEVEL_INDEX)],
        (F.round(hits / F.col("n_rows"), 4) == F.col("accuracy")).alias("accuracy_follows"),
        (F.col("train_time_s") > 0).alias("timed"),
        F.array_join(F.transform(F.array_sort(F.map_entries("parameters")), lambda e: F.concat(
            e["key"], F.lit("="), e["value"])), ",").alias("parameters"))


def _tuned(spark, sf_dir, name, settings):
    """(position, params as text, f1, is_best) of a three-fold search, folds by key hash."""
    _, _, vectors = _training_set(hourly_rule(spark, sf_dir))
    fitted = tr.cross_validate(tr.candidate(name, settings), vectors, settings, "fold")
    vectors.unpersist()
    return tr.cv_scores(spark, fitted).select(
        "position", F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(
            e["key"], F.lit("="), e["value"])), ",").alias("params"),
        F.round("f1", 4).alias("f1"), "is_best")


def cv_best(spark, sf_dir):
    """Search over tree depths."""
    return _tuned(spark, sf_dir, "DecisionTree", SETTINGS)


#: Inputs of the noisy rule: one category, so the best rule is known for every model.
NOISY_FEATURES = FeatureSpec(scalars=(), categories=("weather_main",))
# The level most events of a type have, and one in how many has the next one.
NOISY_LEVELS = {"view": ("low", 5), "click": ("high", 4), "signup": ("medium", 7),
                "error": ("high", 9), "purchase": ("low", 6)}


def noisy_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared observations whose level follows the weather, but for some of each kind.

    No model can do better than the most frequent level of a kind, so every figure
    of a model that finds it follows from counts.
    """
    volumes = {"low": 1000, "medium": 2500, "high": 4000}
    after = {"low": "medium", "medium": "high", "high": "low"}
    volume = F.lit(None).cast("int")
    for kind, (level, each) in NOISY_LEVELS.items():
        other = F.col("event_id") % each == 0
        volume = F.when(F.col("weather_main") == WEATHER_OF[kind], F.when(
            other, volumes[after[level]]).otherwise(volumes[level])).otherwise(volume)
    return prepare(observations(spark, sf_dir).withColumn("traffic_volume", volume), OBSERVED)


def _points(scores):
    return scores.withColumns({
        "params": F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(
            e["key"], F.lit("="), e["value"])), ","),
        "f1": F.round("f1", 4)})


def _noisy_search(spark, sf_dir, name):
    _, _, vectors = _training_set(noisy_rule(spark, sf_dir), NOISY_FEATURES)
    fitted = tr.cross_validate(tr.candidate(name, SETTINGS), vectors, SETTINGS, "fold")
    vectors.unpersist()
    return _points(tr.cv_scores(spark, fitted))


def cv_best_linear(spark, sf_dir):
    """The whole grid of the linear model, by Spark's own cross-validation."""
    return _noisy_search(spark, sf_dir, "LogisticRegression")


def cv_best_forest(spark, sf_dir):
    """The whole grid of the forest, by Spark's own cross-validation."""
    return _noisy_search(spark, sf_dir, "RandomForest")


def grid_search(spark, sf_dir):
    """All grids of all models over folds they share: one layout and one scoring pass a fold."""
    _, _, vectors = _training_set(noisy_rule(spark, sf_dir), NOISY_FEATURES)
    cells = search.fold_cells(
        tr.candidates(SETTINGS), vectors, SETTINGS, search.cells_table(spark))
    vectors.unpersist()
    return _points(search.grid_scores(cells))


def additive_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared observations whose volume adds up weather, weekend and hour of day."""
    weekend = F.dayofweek("date_time").isin(1, 7).cast("int")
    night = (F.hour("date_time") < 6).cast("int")
    weather = sum((F.when(F.col("weather_main") == w, v).otherwise(0) for w, v in (
        ("Clouds", 1000), ("Snow", 2000), ("Fog", 3000), ("Rain", 4000))), F.lit(0))
    return prepare(observations(spark, sf_dir).withColumn(
        "traffic_volume", weather + 1000 * weekend - 3000 * night), OBSERVED)


def _additive_scores(rows, features, name, settings):
    test, feature_model, vectors = _training_set(rows, features)
    fitted, _ = tr.fit_timed(tr.candidate(name, settings), vectors, settings)
    vectors.unpersist()
    return tr.score(test, tr.full_model(feature_model, fitted), features.scalars).groupBy(
        "congestion", "predicted_level").agg(F.count(F.lit(1)).alias("n"))


def rf_scores_cells(spark, sf_dir):
    """A forest on a rule of several inputs: weather, weekend and hour together."""
    features = FeatureSpec(scalars=("hour", "is_weekend", "month"), categories=("weather_main",))
    return _additive_scores(additive_rule(spark, sf_dir), features, "RandomForest",
                            SETTINGS.fitted_with("RandomForest", featureSubsetStrategy="all"))


def lr_scores_cells(spark, sf_dir):
    """The linear model on the same rule by day: weather and weekend add up."""
    features = FeatureSpec(scalars=("is_weekend",), categories=("weather_main",))
    by_day = additive_rule(spark, sf_dir).where("hour >= 6")
    return _additive_scores(by_day, features, "LogisticRegression", SETTINGS)


def resumed_results(spark, sf_dir):
    """Results of a run that broke after its first model and was resumed, twice."""
    out = scratch_uri(spark, "resumed")
    table = write_table(noisy_rule(spark, sf_dir), f"{out}/observations")
    test = table.where(F.col("split") == "test")
    log = RunLog(spark, f"{out}/log", "resumed", run_id="resumed")
    linear = ModelSettings(params={"LogisticRegression": SETTINGS.params["LogisticRegression"]})
    for settings in (linear, SETTINGS, SETTINGS):
        train_all(table, test, out, OBSERVED, NOISY_FEATURES, settings, log, "resumed", resume=True)
    cells = F.array_join(F.transform(F.flatten("confusion_matrix"), lambda n: n.cast("string")), ",")
    return read_results(spark, out, "resumed").select(
        "position", "model", "accuracy", "precision", "recall", "f1", "n_rows", cells.alias("cells"))


def run_summary_document(spark, sf_dir):
    """The summary of a run, written as JSON and read back as paths and values."""
    out = scratch_uri(spark, "summary")
    table = write_table(noisy_rule(spark, sf_dir), f"{out}/observations")
    test = table.where(F.col("split") == "test")
    log = RunLog(spark, None, "summary", run_id="summary")
    tree = ModelSettings(params={"DecisionTree": SETTINGS.params["DecisionTree"]})
    scores, _ = train_all(table, test, out, OBSERVED, NOISY_FEATURES, tree, log)
    alerts = alert_sample(scores["DecisionTree"], OBSERVED, 8, True)
    summary = run_summary(
        pr.load_summary(table.select(*observations(spark, sf_dir).columns), "date_time", "events"),
        table, read_results(spark, out), alerts, "DecisionTree", tree, log)
    uri = write_json(summary, f"{out}/run_summary", single_file=True)
    return read_document_paths(spark, uri).where(
        ~F.col("path").rlike("train_time_s|^settings|feature_importances")).select("path", "value")


def hashed_features(spark, sf_dir):
    """Customers of any number in 256 slots of the vector, beside a price."""
    features = FeatureSpec(scalars=("o_totalprice",), categories=(), hashed=("o_custkey",), hash_slots=256)
    orders = _table(spark, sf_dir, "orders")
    vector = vector_to_array("features")
    built = ft.fit_features(orders, features).transform(orders).select("o_orderkey", vector.alias("v"))
    hashed = F.slice("v", F.lit(2), F.lit(256))
    return built.select(
        "o_orderkey", F.get("v", F.lit(0)).alias("price"),
        (F.array_position(hashed, F.lit(1.0)) - 1).alias("slot"),
        F.aggregate(hashed, F.lit(0.0), lambda a, x: a + x).alias("total"))


def kept_sketches(spark, sf_dir):
    """Quantiles of years from kept sketches of days: counts and ends are exact, ranks are
    counted over the rows and held against the sketch's error."""
    rows = _table(spark, sf_dir, "lineitem")
    kept = write_table(
        sketches.period_sketches(rows, F.to_date("l_shipdate"), SKETCHED), scratch_uri(spark, "sketches"))
    year = F.year("period").alias("year")
    found = sketches.range_quantiles(kept, by=[year]).unionByName(
        sketches.range_quantiles(kept).withColumn("year", F.lit(0)))
    wide = found.groupBy("year", "column", "n", "lowest", "highest").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"v{i}")
        for i, p in enumerate(QUANTILE_PROBS)])
    values = rows.select(F.year("l_shipdate").alias("y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in SKETCHED]))
    ).select(F.explode(F.array("y", F.lit(0))).alias("year"), "column", "x")
    # One row per year and column; by a shuffle all rows of year 0 would meet in one task.
    ranked = values.join(F.broadcast(wide), ["year", "column"]).groupBy("year", "column", "n", "lowest", "highest").agg(*[
        x for i in range(len(QUANTILE_PROBS))
        for x in (F.count_if(F.col("x") < F.col(f"v{i}")).alias(f"lt{i}"),
                  F.count_if(F.col("x") <= F.col(f"v{i}")).alias(f"le{i}"))])
    slack = 2 * sketches.rank_error() * F.col("n") + 1
    return ranked.select("year", "column", "n", "lowest", "highest", F.inline(F.array(*[
        F.struct(F.lit(p).alias("prob"), ((F.col(f"lt{i}") <= p * F.col("n") + slack) & (
            F.col(f"le{i}") >= p * F.col("n") - slack)).alias("within"))
        for i, p in enumerate(QUANTILE_PROBS)])))


# --------------------------------------------------------------------------
# Sources and sinks: written below the session's shared folder, read again
# --------------------------------------------------------------------------

def _raw_observations(spark, sf_dir):
    """Observations in the layout of the raw file, times to the second."""
    rows = observations(spark, sf_dir).withColumn(
        "date_time", F.date_trunc("second", "date_time").cast("timestamp"))
    return rows.select(*[f.name for f in RAW_SCHEMA.fields])


def _read_raw(df):
    return df.withColumn("date_time", F.date_format("date_time", pr.TIME_FORMAT))


def csv_scan(spark, sf_dir):
    """Typed scan of CSV files with a header."""
    uri = write_csv(_raw_observations(spark, sf_dir), scratch_uri(spark, "raw"))
    return _read_raw(read_observations(spark, uri))


def gzip_csv_scan(spark, sf_dir):
    """The first source that exists is a folder of gzip files."""
    uri = scratch_uri(spark, "raw_gzip")
    _raw_observations(spark, sf_dir).write.option("header", True).option(
        "compression", "gzip").csv(uri)
    df, _ = first_available(spark, [scratch_uri(spark, "absent"), uri], rebalance=True)
    return _read_raw(df)


def saved_profile(spark, sf_dir):
    """The category table of a written profile, read back as CSV."""
    uri = scratch_uri(spark, "profile")
    report.write_profile(observations(spark, sf_dir), uri, OBSERVED)
    return _rounded(read_report_csv(
        spark, f"{uri}/profile_weather_volume",
        "weather_main string, avg_volume double, n_records bigint"), "avg_volume")


def saved_class_counts(spark, sf_dir):
    levels = cl.add_level(_table(spark, sf_dir, "lineitem").select("l_quantity"), QUANTITY)
    uri = write_csv(pr.class_counts(levels), scratch_uri(spark, "class_counts"), single_file=True)
    return read_report_csv(spark, uri, "congestion string, count bigint")


def saved_class_metrics(spark, sf_dir):
    """Per-class metrics as JSON lines, read back."""
    uri = write_json(per_class_metrics(spark, sf_dir), scratch_uri(spark, "per_class"))
    return spark.read.schema(
        "model string, level string, precision double, recall double, f1 double, support bigint"
    ).json(uri)


def saved_alerts(spark, sf_dir):
    """Alert records of observed levels as JSON, read back."""
    rows = alert_sample(prepare(observations(spark, sf_dir), OBSERVED), OBSERVED, 8, False)
    uri = write_json(rows, scratch_uri(spark, "alerts"), single_file=True)
    return spark.read.schema(rows.schema).json(uri).select("datetime", "predicted_level", "alert")


def mounted_tables(spark, sf_dir):
    """Raw observations written and read by URIs of a mounted store, as CSV, then as Parquet."""
    store = mount(spark, f"store{os.getpid()}x{id(sf_dir)}", {"/data": scratch_uri(spark, "store")})
    csv = write_csv(_raw_observations(spark, sf_dir), f"{store}/data/raw")
    df, used = first_available(spark, [f"{store}/data/absent", csv])
    assert used == csv
    return _read_raw(write_table(df, f"{store}/data/table"))


def saved_alert_contexts(spark, sf_dir):
    """The contexts of written alert records, read back with their types."""
    rows = alert_sample(prepare(observations(spark, sf_dir), OBSERVED), OBSERVED, 8, False)
    uri = write_json(rows, scratch_uri(spark, "alerts"), single_file=True)
    return spark.read.schema(rows.schema).json(uri).select(
        "datetime", "context.level", "context.hour", "context.day_name", "context.weather_main",
        "context.weather_description", "context.holiday", "context.p_low", "context.p_medium",
        "context.p_high", F.round("context.temp_c", 4).alias("temp_c"))


def saved_sample(spark, sf_dir):
    """The processed sample as one CSV file, read back."""
    rows = processed_sample(prepare(observations(spark, sf_dir), OBSERVED), OBSERVED)
    uri = write_csv(rows, scratch_uri(spark, "sample"), single_file=True)
    return read_report_csv(spark, uri, rows.schema)


def schema_listing(spark, sf_dir):
    """Columns and types of every bundled star table, as Spark reads them."""
    tables = [pr.schema_listing(_table(spark, sf_dir, t)).select(F.lit(t).alias("table"), "*")
              for t in ("events", "orders", "documents", "conversations")]
    listed = tables[0]
    for table in tables[1:]:
        listed = listed.union(table)
    return listed.select("table", "position", "name", F.regexp_replace(
        "type", "^(timestamp_ntz|timestamp)$", "time").alias("type"))


def profile_document_paths(spark, sf_dir):
    """The written profile document as paths and values: what does not hang on rounding."""
    uri = scratch_uri(spark, "profile")
    report.write_profile(observations(spark, sf_dir), uri, OBSERVED)
    paths = read_document_paths(spark, f"{uri}/profile")
    return paths.where(F.col("path").rlike(
        "^(row_count|column_count|null_counts|hourly_volume.*(hour|n_records)|"
        "weather_main_distribution|holiday_distribution|weather_volume_table)")).select("path", "value")


def run_log_events(spark, sf_dir):
    """Two runs that log to one place in turns, with events that a retry repeats."""
    uri = scratch_uri(spark, "log")
    kinds = _table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))
    logs = [RunLog(spark, uri, "both", run_id=f"run-{i}") for i in range(2)]
    for log in logs:
        log.start(source="events")
    for _ in range(2):
        for i, log in enumerate(logs):
            log.record_profile(kinds.where(F.length("event_type") % 2 == i).agg(
                F.sum("n").alias("row_count"), F.max("most").alias("most")))
    logs[0].record_model("first", {"depth": 1}, {"f1": 0.5})
    logs[0].record_model("first", {"depth": 1}, {"f1": 0.5})
    logs[1].record_model("second", {"depth": 2}, {"f1": 0.25})
    for log in logs:
        log.finish()
    return RunLog.runs(spark, uri).select(
        "run_id", "experiment", F.col("settings")["source"].alias("source"),
        F.array_join("models", ",").alias("models"),
        F.col("profile_summary")["row_count"].alias("row_count"),
        F.col("profile_summary")["most"].alias("most"),
        (F.col("started_at") <= F.col("finished_at")).alias("in_order"))


# --------------------------------------------------------------------------
# Contract
# --------------------------------------------------------------------------

QUERIES = (
    hourly_profile, dow_profile, monthly_profile, category_profile, text_category_profile,
    category_topn, category_topn_many, numeric_summary, null_audit, quantiles_exact,
    quantiles_exact_lineitem, quantiles_approx, load_summary, profile_suite,
    profile_categories_wide, profile_document, describe_text, dow_chart,
    category_chart, clean_observations, clean_filter_first, distinct_customers,
    calendar_features, hour_buckets, day_name, holiday_null_rule, holiday_days, null_defaults, congestion_label,
    class_counts, stratified_pick, deterministic_sample, processed_rows, hash_split_counts,
    hash_split_seeded, hash_folds, category_index, category_index_wide, label_index, one_hot_flat, assembled_features, histogram50, hexbin40,
    confusion_dense, confusion_named, weighted_metrics, per_class_metrics, metrics_long,
    best_worst_model, model_gap, best_recall_range, alert_text, prompt_table, request_bodies,
    response_parse, adhoc_alerts, lr_scores, dt_scores, rf_scores, saved_model_scores,
    predicted_alerts, importances, importances_by_source, model_results, cv_best, cv_best_linear, cv_best_forest,
    grid_search, rf_scores_cells, lr_scores_cells, resumed_results, run_summary_document, hashed_features, kept_sketches,
    mounted_tables, saved_alert_contexts, saved_sample, schema_listing, profile_document_paths,
    run_log_events,
    csv_scan, gzip_csv_scan, saved_profile, saved_class_counts, saved_class_metrics, saved_alerts,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: average, median and rows by hour of day."""
    return hourly_profile(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ours = {query.__name__: query for query in QUERIES}
    return ours | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES) | (llm.oracle_sql() if llm else {})
