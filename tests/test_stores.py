"""Nested documents, mounted stores, the shared run log, kept sketches, numbering, hashing."""

import json
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import functions as F

from rushline.operators import features as ft
from rushline.operators import sketches
from rushline.operators import training as tr
from rushline.operators.ranking import numbered
from rushline.plans import run
from rushline.sinks import RunLog, write_csv, write_table
from rushline.sources import (
    first_available, flatten_documents, mount, read_document_paths, read_observations,
)
from rushline.spec import FeatureSpec, ModelSettings
from tests.data import hourly_table


def flat(value, path=""):
    """(path, text) of every leaf of a parsed document."""
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in flat(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in flat(v, f"{path}[{i}]")]
    if value is None or value in ({}, []):
        return [(path, None)]
    return [(path, {True: "true", False: "false"}.get(value, str(value)) if isinstance(value, bool) else str(value))]


def test_documents_as_paths(spark, tmp_path):
    document = {"a": 1, "b": {"c": "x", "d": [{"e": 2.5, "f": None}, {"e": 3.5, "f": True}], "g": []},
                "h": [[1, 2], [], [3]], "i": None, "j": ""}
    (tmp_path / "one.json").write_text(json.dumps(document, indent=1))
    rows = read_document_paths(spark, str(tmp_path)).collect()
    assert sorted((r["path"], r["value"]) for r in rows) == sorted(flat(document))
    assert {Path(r["document"]).name for r in rows} == {"one.json"}


def test_maps_and_null_structs_as_paths(spark):
    df = spark.sql("""select 7 as id, map('k', named_struct('v', 1), 'l', null) as m,
        cast(null as struct<x:int,y:int>) as s, map() as e, array(map('z', array(1))) as n""")
    got = sorted(tuple(r) for r in flatten_documents(df, "id").collect())
    assert got == [(7, "e", None), (7, "m.k.v", "1"), (7, "m.l", None), (7, "n[0].z[0]", "1"), (7, "s", None)]


def test_many_documents_stay_apart(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(json.dumps({"n": i, "list": list(range(i))}))
    rows = read_document_paths(spark, str(tmp_path))
    assert rows.where("path = 'n'").count() == 5
    assert rows.where("path like 'list%'").count() == 1 + 1 + 2 + 3 + 4


def test_whole_run_on_a_mounted_store(spark, tmp_path):
    """Every artifact of a run is written to and read from another URI scheme."""
    store = mount(spark, "runstore", {"/raw": str(tmp_path / "a"), "/out": str(tmp_path / "b")})
    (tmp_path / "a").mkdir()
    csv = write_csv(hourly_table(spark, 600), f"{store}/raw/obs")
    raw, used = first_available(spark, [f"{store}/raw/none", csv])
    assert used == csv and raw.count() == 600
    settings = ModelSettings(params={"DecisionTree": {"maxDepth": 3, "maxBins": 64}})
    row = run(spark, raw, f"{store}/out/run", settings=settings, source=used, log_uri=f"{store}/out/log").first()
    assert row["load"]["source"] == csv and row["train_rows"] + row["test_rows"] == 600
    assert (tmp_path / "b" / "run" / "results" / "run_summary").is_dir()
    table = write_table(raw, f"{store}/out/table")
    assert read_observations(spark, f"{store}/out/table", fmt="parquet").count() == table.count()
    assert RunLog.runs(spark, f"{store}/out/log").first()["models"] == ["DecisionTree"]
    paths = {r["path"]: r["value"] for r in read_document_paths(
        spark, f"{store}/out/run/results/run_summary").collect()}
    assert paths["load.rows"] == "600" and paths["model_results[0].model"] == "DecisionTree"


def test_runs_that_log_at_the_same_time(spark, tmp_path):
    uri = str(tmp_path / "log")

    def one(i):
        log = RunLog(spark, uri, "many", run_id=f"r{i}")
        log.start(number=i)
        for _ in range(2):  # a retry
            log.record_model(f"m{i}", {"n": i}, {"f1": i / 10})
        log.record_model("last", {}, {"f1": 1.0})
        log.finish()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(6)))
    runs = {r["run_id"]: r for r in RunLog.runs(spark, uri).collect()}
    assert sorted(runs) == [f"r{i}" for i in range(6)]
    for i in range(6):
        row = runs[f"r{i}"]
        assert row["models"] == ["last", f"m{i}"] and row["settings"]["number"] == str(i)
        assert row["started_at"] <= row["finished_at"]
    assert RunLog.events(spark, uri).count() == 6 * 4
    assert spark.read.parquet(uri).count() == 6 * 5


def test_last_event_counts(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), "x", run_id="r")
    for f1 in (0.1, 0.2, 0.9):
        log.record_model("m", {}, {"f1": f1})
    (row,) = RunLog.events(spark, str(tmp_path)).collect()
    assert row["metrics"] == {"f1": 0.9}


def test_merged_sketches_keep_their_error(spark):
    """Ranks from 40 merged days, one of them a third of all rows, within the bound."""
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("day"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("x"),
        F.when(F.col("id") % 2 == 0, F.lit(5.0)).alias("half_null"), F.lit(None).cast("double").alias("none"))
    kept = sketches.period_sketches(rows, F.col("day"), ["x", "half_null", "none"])
    assert kept.where("column = 'none'").count() == 0
    found = sketches.range_quantiles(kept, (0.0, 0.01, 0.5, 0.99, 1.0)).collect()
    values = sorted(r["x"] for r in rows.select("x").collect())
    for r in found:
        assert r["n"] == (90_000 if r["column"] == "x" else 45_000)
        if r["column"] == "x":
            at = sum(v <= r["value"] for v in values) / len(values)
            assert abs(at - r["prob"]) <= sketches.rank_error() + 1 / len(values)
            assert r["lowest"] == values[0] and r["highest"] == values[-1]
        else:
            assert r["value"] == 5.0
    by_parity = sketches.range_quantiles(kept.where("column = 'x'"), (0.5,), by=[(F.col("period") % 2).alias("odd")])
    assert {r["odd"]: r["n"] for r in by_parity.collect()} == {0: 60_000, 1: 30_000}
    empty = sketches.range_quantiles(sketches.period_sketches(rows.limit(0), F.col("day"), ["x"]))
    assert empty.count() == 0


def test_numbering_follows_the_order(spark):
    df = spark.range(5_000).select((F.pmod(F.xxhash64("id"), F.lit(700))).alias("n"), "id",
                                   F.lit("clash").alias("task"), F.lit("clash").alias("place"))
    rows = numbered(df, [F.desc("n"), F.asc("id")]).orderBy("number").collect()
    assert [r["number"] for r in rows] == list(range(5_000))
    assert [(r["n"], r["id"]) for r in rows] == sorted(
        ((r["n"], r["id"]) for r in rows), key=lambda x: (-x[0], x[1]))
    assert set(rows[0].asDict()) == {"n", "id", "task", "place", "number"}
    # rows equal in the order, and none at all
    same = numbered(spark.range(900).select(F.lit(1).alias("x")), [F.asc("x")])
    assert sorted(r["number"] for r in same.collect()) == list(range(900))
    assert numbered(df.limit(0), [F.asc("n")]).count() == 0


def test_no_index_goes_through_python(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("v"))
    plan = ft.category_index(df, "v")._jdf.queryExecution().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan


def test_hashed_categories(spark, tmp_path):
    spec = FeatureSpec(scalars=("hour",), categories=("w",), hashed=("u", "p"), hash_slots=50)
    df = spark.range(300).select(
        F.col("id").alias("hour"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("w"),
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("user"), "id")).alias("u"),
        (F.col("id") % 3).alias("p"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    model = ft.fit_features(df, spec)
    built = model.transform(df)
    names = ft.slot_names(built)
    assert len(names) == 1 + 2 + 50 + 50 and names[3] == "u_hash_0" and names[-1] == "p_hash_49"
    assert ft.slot_source("u_hash_7", spec) == "u" and ft.slot_source("p_hash_0", spec) == "p"
    for row in built.withColumns({"su": ft.hash_slot("u", F.col("u"), 50), "sp": ft.hash_slot(
            "p", F.col("p").cast("string"), 50)}).collect():
        hot = [names[i] for i in row["features"].indices if names[i].startswith(("u_", "p_"))]
        wanted = ([] if row["u"] is None else [f"u_hash_{int(row['su'])}"]) + [f"p_hash_{int(row['sp'])}"]
        assert hot == wanted
    # the whole model is saved, loaded and scores values it never saw
    fitted, _ = tr.fit_timed(tr.candidate("DecisionTree"), built, ModelSettings())
    uri = tr.save_model(tr.full_model(model, fitted), str(tmp_path / "m"))
    unseen = spark.createDataFrame([(1, "zzz", "never", 9)], "hour long, w string, u string, p long")
    assert tr.load_model(uri).transform(unseen).first()["prediction"] in (0.0, 1.0)
    assert sum(f.stat().st_size for f in (tmp_path / "m").rglob("*") if f.is_file()) < 200_000


MILLION = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from rushline.operators import features as ft, training as tr
from rushline.spec import FeatureSpec, ModelSettings
spark = (SparkSession.builder.master("local[4]").config("spark.driver.memory", "1g")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
df = spark.range(1000000).select(F.concat(F.lit("value"), "id").alias("v"), (F.col("id") % 5).alias("x"),
    (F.col("id") % 5).cast("double").alias("label"))
spec = FeatureSpec(scalars=("x",), categories=(), hashed=("v",))
built = ft.fit_features(df, spec).transform(df)
settings = ModelSettings().fitted_with("LogisticRegression", maxIter=3)
model, _ = tr.fit_timed(tr.candidate("LogisticRegression", settings), built, settings)
print("width", model.numFeatures, "rows", built.count())
spark.stop()
"""


def test_a_million_values_under_a_small_driver():
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", MILLION.format(root=root)], capture_output=True,
                          text=True, timeout=600)
    assert f"width {1 + FeatureSpec().hash_slots} rows 1000000" in done.stdout, done.stderr[-2000:]
