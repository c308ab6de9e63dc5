"""V8, V9."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rushline.operators import bins


def test_histogram_matches_numpy(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    values = [r[0] for r in df.select("value").collect()]
    rows = bins.histogram(df, "value", 50).orderBy("bin").collect()
    counts, edges = np.histogram(values, 50)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["lower"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_marks_the_level_bounds(spark):
    df = spark.range(101).select(F.col("id").alias("v"))
    rows = bins.histogram(df, "v", 10, low_max=15, high_min=100).collect()
    assert [r["bin"] for r in rows if r["has_low_max"]] == [1]
    assert [r["bin"] for r in rows if r["has_high_min"]] == [9]


def test_constant_and_null_columns(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,), (float("nan"),)], "v double")
    rows = bins.histogram(df, "v", 4).orderBy("bin").collect()
    assert sum(r["n"] for r in rows) == 2 and rows[0]["lower"] == 2.5
    assert bins.hexbin(df.withColumn("w", F.col("v")), "v", "w").agg(F.sum("n")).first()[0] == 2


def test_hexagons_are_the_nearest_centres(spark, sf_dir):
    """Brute force: every centre of both lattices against every point of a fixture."""
    grid = 8
    df = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") % 97).alias("y"))
    points = np.array([tuple(r) for r in df.collect()])
    rows = int(grid / 3 ** 0.5)
    low, high = points.min(0), points.max(0)
    step = (high - low) / (grid, rows)
    centres = np.array(
        [(i, j) for i in range(grid + 1) for j in range(rows + 1)]
        + [(i + 0.5, j + 0.5) for i in range(grid) for j in range(rows)])
    scaled = (points - low) / step
    distance = ((scaled[:, None, 0] - centres[:, 0]) ** 2
                + 3 * (scaled[:, None, 1] - centres[:, 1]) ** 2)
    # a tie between the lattices goes to the second, the later centres
    nearest = len(centres) - 1 - np.argmin(distance[:, ::-1].round(12), axis=1)
    expected = {}
    for c in nearest:
        place = tuple((low + centres[c] * step).round(6))
        expected[place] = expected.get(place, 0) + 1
    found = {(round(r["center_x"], 6), round(r["center_y"], 6)): r["n"]
             for r in bins.hexbin(df, "x", "y", grid).collect()}
    assert sum(found.values()) == len(points)
    differing = {k for k in found.keys() | expected.keys() if found.get(k) != expected.get(k)}
    assert not differing


def test_bins_need_no_join_with_the_range(spark):
    df = spark.range(100).select(F.col("id").alias("x"), F.col("id").alias("y"))
    plan = bins.hexbin(df, "x", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan
