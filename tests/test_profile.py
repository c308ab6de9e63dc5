"""A1-A11, A13, S5."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from rushline.operators import profile as pr
from rushline.operators import quantiles as qu
from rushline.plans import profile_only, write_profile
from tests.data import hourly_table


def test_summary_in_both_layouts(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 4), (4.0, None)], "a double, b int")
    typed = {r["column"]: r for r in pr.numeric_summary(df, ["a", "b"]).collect()}
    assert typed["a"]["count"] == 3 and typed["b"]["count"] == 2
    assert typed["a"]["stddev"] == pytest.approx(statistics.stdev([1, 2, 4]))
    ours = pr.describe_text(df, ["a", "b"]).collect()
    assert ours == df.describe("a", "b").collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, t timestamp")
    assert [tuple(r) for r in pr.null_counts(df).collect()] == [("a", 0), ("t", 0)]
    assert pr.load_summary(df, "t", "x").first()["rows"] == 0
    assert qu.exact_quantiles(df, "a").filter("value is not null").count() == 0
    assert pr.hourly_profile(df, "t", "a").count() == 0


def test_top_n_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "v string")
    rows = pr.category_counts(df, "v", 2).collect()
    assert [tuple(r) for r in rows] == [("a", 2), ("b", 2)]


def test_approximate_quantiles_stay_within_their_rank_error(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    values = np.sort([r[0] for r in df.select("l_extendedprice").collect()])
    for row in pr.approx_quantiles(df, ["l_extendedprice"]).collect():
        low = np.searchsorted(values, row["value"], "left") / len(values)
        high = np.searchsorted(values, row["value"], "right") / len(values)
        assert low - 0.001 <= row["prob"] <= high + 0.001


@pytest.mark.parametrize("shape", ["spread", "hot", "heavy_tail", "two_values", "neighbours"])
def test_exact_quantiles_match_brute_force(spark, shape):
    """Forced through several rounds: nothing is read while over 5 rows are left."""
    i = F.col("id")
    value = {
        "spread": F.pmod(F.xxhash64("id"), F.lit(10 ** 9)) / 7,
        "hot": F.when(i % 3 == 0, 5.0).otherwise(i / 100),
        "heavy_tail": F.pow(F.lit(10.0), (i % 600) - 300),
        "two_values": F.when(i < 4_000, 1.0).otherwise(2.0),
        "neighbours": F.when(i < 3_000, 1.0).when(i > 3_010, 3.0).otherwise(2 + i / 10_000),
    }[shape]
    df = spark.range(6_001).select(value.alias("v"))
    probs = (0.0, 0.1, 1 / 3, 0.5, 0.5003, 0.75, 0.999, 1.0)
    found = {r["prob"]: r["value"]
             for r in qu.exact_quantiles(df, "v", probs, accuracy=50).collect()}
    values = [r[0] for r in df.collect()]
    for p in probs:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_exact_quantiles_of_infinite_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "v double")
    found = {r["prob"]: r["value"] for r in qu.exact_quantiles(df, "v", [0.0, 0.5, 1.0]).collect()}
    assert found == {0.0: 1.0, 0.5: 2.0, 1.0: float("inf")}


def test_exact_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "v double")
    assert qu.exact_quantiles(df, "v", [0.5]).first()["value"] == 2.0


def test_suite_equals_the_single_profiles(spark):
    df = hourly_table(spark, 2_000)
    suite = pr.profile_suite(df, "date_time", "traffic_volume", ["weather_main", "holiday"])
    rows = {(r["dimension"], r["value"]): r for r in suite.collect()}
    for r in pr.weekday_profile(df, "date_time", "traffic_volume").collect():
        match = rows["dow", str(r["dow"])]
        assert match["n_records"] == r["n_records"]
        assert match["avg_volume"] == pytest.approx(r["avg_volume"])
    for r in pr.category_counts(df, "holiday").collect():
        assert rows["holiday", r["holiday"]]["n_records"] == r["count"]
    for name in ("hour", "dow", "month", "weather_main", "holiday"):
        assert sum(r["n_records"] for (d, _), r in rows.items() if d == name) == 2_000


def test_profile_files_and_document(spark, tmp_path):
    df = hourly_table(spark, 1_500)
    profile = write_profile(df, str(tmp_path))
    headers = {
        "profile_numeric_summary": "summary,temp,rain_1h,snow_1h,clouds_all,traffic_volume",
        "profile_weather_main": "weather_main,count",
        "profile_holiday": "holiday,count",
        "profile_hourly_volume": "hour,avg_volume,median_volume,n_records",
        "profile_dow_volume": "dow,avg_volume,n_records",
        "profile_monthly_volume": "month,avg_volume",
        "profile_weather_volume": "weather_main,avg_volume,n_records",
    }
    for name, header in headers.items():
        files = sorted((tmp_path / name).glob("part-*.csv"))
        assert files and files[0].read_text().splitlines()[0] == header
    document = profile["document"].first()
    assert document["row_count"] == 1_500 and document["column_count"] == 9
    assert document["null_counts"]["temp"] == 0 and len(document["null_counts"]) == 9
    assert [r["hour"] for r in document["hourly_volume"]] == list(range(24))
    assert document["schema"][0]["name"] == "holiday"
    assert [r["summary"] for r in document["numeric_summary"]] == [
        "count", "mean", "stddev", "min", "max"]
    counts = [r["count"] for r in document["weather_main_distribution"]]
    assert counts == sorted(counts, reverse=True) and sum(counts) == 1_500
    q = document["traffic_volume_quantiles"]
    assert q["p05"] <= q["p25"] <= q["p50"] <= q["p75"] <= q["p95"]


def test_written_tables_equal_direct_ones(spark, tmp_path):
    df = hourly_table(spark, 1_000)
    tables = write_profile(df, str(tmp_path))
    direct = pr.category_profile(df, "weather_main", "traffic_volume").collect()
    assert [r["weather_main"] for r in tables["profile_weather_volume"].collect()] == [
        r["weather_main"] for r in direct]


def test_wide_category_is_written_whole(spark, tmp_path):
    df = hourly_table(spark, 1_200).withColumn(
        "weather_main", F.concat(F.lit("w"), F.unix_timestamp("date_time")))
    tables = write_profile(df, str(tmp_path))
    assert tables["profile_weather_volume"].count() == 1_200
    document = tables["document"].first()
    assert len(document["weather_main_distribution"]) == 20
    assert document["weather_volume_table"] == "profile_weather_volume"
    rows = spark.read.parquet(str(tmp_path / "profile_rows"))
    assert rows.filter("section = 'profile_weather_volume' and name = 'n_records'").count() == 1_200


def test_cells_grow_with_the_sum_of_the_categories(spark):
    df = hourly_table(spark, 5_000).withColumns({
        "weather_main": (F.unix_timestamp("date_time") / 3600 % 1_000).cast("string"),
        "holiday": F.floor(F.unix_timestamp("date_time") / 18_000 % 1_000).cast("string")})
    cells = pr.profile_cells(df, "date_time", "traffic_volume", ["weather_main", "holiday"])
    assert cells.filter("part <> 'calendar'").count() == 2_000
    assert cells.filter("part = 'calendar'").count() <= 24 * 7 * 12


def test_schema_listing(spark):
    rows = pr.schema_listing(hourly_table(spark, 1)).orderBy("position").collect()
    assert (rows[0]["name"], rows[0]["type"]) == ("holiday", "string") and len(rows) == 9


def test_profile_only_cleans_first(spark, tmp_path):
    df = hourly_table(spark, 300)
    document = profile_only(df.unionByName(df).repartition(4), str(tmp_path)).first()
    assert document["row_count"] == 300
