"""S1-S7."""

import gzip

import pytest
from pyspark.sql import functions as F

from rushline.operators import cleaning as cl
from rushline.sources import (
    RAW_SCHEMA,
    first_available,
    join_uri,
    read_observations,
    read_report_csv,
    read_report_json,
)
from tests.data import BOUNDARY_CSV, hourly_table


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(BOUNDARY_CSV)
    return str(path)


def test_typed_csv_scan_turns_bad_fields_into_null(spark, csv_file):
    df = read_observations(spark, csv_file)
    assert df.schema == RAW_SCHEMA
    assert df.count() == 11
    noon = df.filter(F.hour("date_time") == 12).first()
    assert noon["rain_1h"] is None and noon["holiday"] is None and noon["temp"] == 290.0


def test_gzip_scan_equals_plain_scan(spark, csv_file, tmp_path):
    packed = tmp_path / "raw.csv.gz"
    packed.write_bytes(gzip.compress(BOUNDARY_CSV.encode()))
    plain = read_observations(spark, csv_file)
    for rebalance in (False, True):
        unpacked = read_observations(spark, str(packed), rebalance=rebalance)
        assert unpacked.exceptAll(plain).isEmpty() and plain.exceptAll(unpacked).isEmpty()


def test_parquet_scan_prunes_columns_and_pushes_filters(spark, sf_dir):
    df = read_observations(spark, f"{sf_dir}/events.parquet", schema=None, fmt="parquet")
    plan = df.filter(F.col("value") > 100).select("event_id")._jdf.queryExecution().toString()
    assert "GreaterThan(value,100.0)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_first_available_skips_missing_paths(spark, csv_file, tmp_path):
    df, used = first_available(spark, [str(tmp_path / "missing.csv"), csv_file])
    assert used == csv_file and df.count() == 11
    with pytest.raises(FileNotFoundError):
        first_available(spark, [str(tmp_path / "missing.csv")])


def test_first_available_can_skip_unreachable_stores(spark, csv_file):
    unreachable = "nosuchscheme://bucket/raw.csv"
    with pytest.raises(Exception):
        first_available(spark, [unreachable, csv_file])
    assert first_available(spark, [unreachable, csv_file], lenient=True)[1] == csv_file


def test_join_uri():
    assert join_uri("s3a://my-bucket/bdt/", "raw/", "/file.csv") == "s3a://my-bucket/bdt/raw/file.csv"


def test_filter_first_reaches_the_csv_scan(spark, csv_file):
    df = read_observations(spark, csv_file)
    plan = cl.clean(df, filter_first=True)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(temp), GreaterThan(temp,200.0)]" in plan


def test_reports_read_back(spark, tmp_path):
    table = hourly_table(spark, 24).groupBy("weather_main").count()
    table.coalesce(1).write.option("header", True).csv(str(tmp_path / "t"))
    back = read_report_csv(spark, str(tmp_path / "t"), "weather_main string, count bigint")
    assert sorted(back.collect()) == sorted(table.collect())
    (tmp_path / "doc.json").write_text('{\n "a": 1,\n "b": {"c": "x"}\n}\n')
    row = read_report_json(spark, str(tmp_path / "doc.json"), "a int, b struct<c string>").first()
    assert row["a"] == 1 and row["b"]["c"] == "x"
