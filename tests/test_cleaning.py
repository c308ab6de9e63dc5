"""D1, D2, P1-P9, P17, X13."""

from pyspark.sql import functions as F

from rushline.functions import calendar as cal
from rushline.functions import text
from rushline.operators import cleaning as cl
from rushline.sources import read_observations
from tests.data import BOUNDARY_CSV


def _boundary(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(BOUNDARY_CSV)
    return read_observations(spark, str(path))


def test_boundary_rows(spark, tmp_path):
    df = cl.add_level(cl.add_calendar(cl.clean(_boundary(spark, tmp_path))))
    rows = {str(r["date_time"]): r for r in df.collect()}
    assert sorted(rows) == [
        "2012-10-02 09:00:00", "2012-10-02 12:00:00", "2012-10-06 13:00:00",
        "2012-10-07 14:00:00", "2012-12-01 15:00:00", "2012-12-25 00:00:00",
    ]
    first = rows["2012-10-02 09:00:00"]
    assert (first["day_of_week"], first["season"], first["is_weekend"], first["is_holiday"]) == (
        3, "fall", 0, 0)
    assert round(first["temp_c"], 2) == 15.13 and first["congestion"] == "high"
    assert first["clouds_all"] == 40  # the tie goes to the smaller row
    assert rows["2012-10-02 12:00:00"]["is_holiday"] == 1
    assert rows["2012-10-02 12:00:00"]["congestion"] == "low"
    assert rows["2012-10-06 13:00:00"]["is_weekend"] == 1
    assert rows["2012-10-06 13:00:00"]["congestion"] == "medium"
    assert rows["2012-10-07 14:00:00"]["is_weekend"] == 1
    assert rows["2012-10-07 14:00:00"]["congestion"] == "medium"
    assert rows["2012-12-01 15:00:00"]["season"] == "winter"
    assert rows["2012-12-01 15:00:00"]["congestion"] == "high"
    assert rows["2012-12-25 00:00:00"]["is_holiday"] == 1
    assert rows["2012-12-25 00:00:00"]["congestion"] == "medium"


def test_filter_first_keeps_the_hour_of_a_faulty_row(spark, tmp_path):
    times = [str(r[0]) for r in cl.clean(
        _boundary(spark, tmp_path), filter_first=True).select("date_time").collect()]
    assert "2013-03-01 08:00:00" in times and len(times) == len(set(times)) == 7


def test_distinct_on_a_hot_and_a_null_key(spark):
    """A third of the rows share one key, another part has none."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id")).alias("k"),
        (-F.col("id")).alias("v"), F.col("id").cast("string").alias("s"))
    out = cl.distinct_on(df, ["k"], ["v"])
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 7").first()["v"] == -29_997
    assert out.filter("k is null").count() == 1
    assert out.columns == df.columns


def test_distinct_on_does_not_depend_on_the_layout(spark):
    df = spark.range(5_000).select((F.col("id") % 50).alias("k"), F.xxhash64("id").alias("v"))
    expected = sorted(cl.distinct_on(df, ["k"]).collect())
    assert sorted(cl.distinct_on(df.repartition(13), ["k"]).collect()) == expected


def test_distinct_on_sends_one_row_per_key_and_task(spark):
    """The hot key is folded before the shuffle."""
    df = spark.range(1_000).select((F.col("id") % 2).alias("k"), "id")
    plan = cl.distinct_on(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_null_rules(spark):
    row = spark.range(1).select(
        cal.season(F.lit(None).cast("int")).alias("season"),
        cal.holiday_flag(F.lit(None).cast("string")).alias("holiday"),
        cal.holiday_flag(F.lit(None).cast("string"), null_is_holiday=False).alias("strict"),
        cal.level(F.lit(None).cast("int"), 1, 2).alias("level"),
        cal.day_name(F.lit(9)).alias("day"),
        cal.weekend_flag(F.lit(None).cast("int")).alias("weekend"),
    ).first()
    assert tuple(row) == ("fall", 1, 0, "medium", "Unknown", 0)


def test_seasons_of_all_months(spark):
    rows = spark.range(1, 13).select(cal.season(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in rows] == (
        ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"])


def test_number_texts_match_python_formatting(spark):
    values = [0.25, 0.35, -0.04, 2.5, 1234.56, 6.57, -2.02, 0.125, 1e7 + 0.25]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", text.fixed(F.col("v"), 1).alias("one"),
                     text.fixed(F.col("v"), 2).alias("two")).collect()
    assert [(r["one"], r["two"]) for r in rows] == [(f"{v:.1f}", f"{v:.2f}") for v in values]
    shares = [0.005, 0.015, 0.8, 0.333, 0.285, 1.0, 0.125]
    df = spark.createDataFrame([(v,) for v in shares], "v double")
    assert [r[0] for r in df.select(text.percent(F.col("v"))).collect()] == [
        int(round(v * 100)) for v in shares]
    hours = spark.range(24).select(text.clock(F.col("id"))).collect()
    assert [r[0] for r in hours] == [f"{h:02d}:00" for h in range(24)]


def test_a_holiday_row_marks_its_day(spark):
    df = spark.sql("""
        select timestamp '2013-01-01 00:00:00' as date_time, 'New Years Day' as holiday, 1 as id
        union all select timestamp '2013-01-01 13:00:00', 'None', 2
        union all select timestamp '2013-01-02 00:00:00', 'None', 3""")
    rows = {r["id"]: r["is_holiday"] for r in cl.spread_holidays(df).collect()}
    assert rows == {1: 1, 2: 1, 3: 0}
