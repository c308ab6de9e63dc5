"""Append-only run log (K9), safe under writers at the same time."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rushline.sources.observations import join_uri

EVENT = ("run_id string, experiment string, kind string, name string, at timestamp, "
         "params map<string,string>, metrics map<string,double>")


class RunLog:
    """One Parquet row per event: start, profile, model (one each), finish.

    Every event is written when it happens, so a broken run leaves what it had
    reached. It goes to a folder of its own, so runs that log to one place at the
    same time share no commit, and an event that a retry writes twice is two rows
    of which the reader takes the last. Without a URI nothing is written.
    """

    def __init__(self, spark: SparkSession, uri: str | None, experiment: str,
                 prefix: str = "run", run_id: str | None = None):
        self.spark = spark
        self.uri = uri
        self.experiment = experiment
        self.run_id = run_id or f"{prefix}-{int(time.time())}-{uuid.uuid4().hex[:8]}"

    def _write(self, event: DataFrame) -> None:
        event.coalesce(1).write.parquet(join_uri(self.uri, f"event={uuid.uuid4().hex}"))

    def _event(self, kind: str, name: str | None = None, params: dict | None = None,
               metrics: dict | None = None) -> None:
        if not self.uri:
            return
        row = (
            self.run_id, self.experiment, kind, name, datetime.now(timezone.utc),
            {k: None if v is None else str(v) for k, v in (params or {}).items()},
            {k: float(v) for k, v in (metrics or {}).items()},
        )
        self._write(self.spark.createDataFrame([row], EVENT))

    def start(self, **settings) -> None:
        self._event("start", params={"spark_master": self.spark.sparkContext.master, **settings})

    def record_model(self, name: str, params: dict, metrics: dict) -> None:
        self._event("model", name, params, metrics)

    def record_results(self, results: DataFrame) -> None:
        """Model events straight from rows of a results table."""
        metrics = ("accuracy", "precision", "recall", "f1", "train_time_s")
        self._from_table(results, "model", F.col("model"), F.col("parameters"), metrics)

    def record_profile(self, summary: DataFrame) -> None:
        """A profile event from a one-row table; its columns are the metrics."""
        self._from_table(summary, "profile", F.lit(None).cast("string"),
                         F.create_map().cast("map<string,string>"), summary.columns)

    def _from_table(self, table: DataFrame, kind: str, name: Column, params: Column,
                    metrics) -> None:
        if not self.uri:
            return
        pairs = [x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))]
        self._write(table.select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.experiment).alias("experiment"),
            F.lit(kind).alias("kind"),
            name.alias("name"),
            F.lit(datetime.now(timezone.utc)).alias("at"),
            params.alias("params"),
            F.create_map(*pairs).alias("metrics"),
        ))

    def finish(self) -> str | None:
        self._event("finish")
        return self.uri

    @staticmethod
    def events(spark: SparkSession, uri: str) -> DataFrame:
        """The last event of every run, kind and name."""
        written = spark.read.schema(f"{EVENT}, event string").parquet(uri)
        # a run has a handful of events of one kind and name
        last = Window.partitionBy("run_id", "experiment", "kind", "name").orderBy(
            F.desc("at"), F.desc("event"))
        return written.withColumn("place", F.row_number().over(last)).where("place = 1").drop(
            "place", "event")

    @staticmethod
    def runs(spark: SparkSession, uri: str) -> DataFrame:
        """One row per run: begin, end, settings, models and profile numbers."""
        log = RunLog.events(spark, uri)

        def of(kind: str, value: Column) -> Column:
            return F.when(F.col("kind") == kind, value)

        return log.groupBy("run_id", "experiment").agg(
            F.min("at").alias("started_at"),
            F.max(of("finish", F.col("at"))).alias("finished_at"),
            F.first(of("start", F.col("params")), ignorenulls=True).alias("settings"),
            F.first(of("profile", F.col("metrics")), ignorenulls=True).alias("profile_summary"),
            # a run has one event per trained model
            F.array_sort(F.collect_list(of("model", F.col("name")))).alias("models"),
        )
