"""T1-T6, P14."""

import json

import pytest
from pyspark.sql import functions as F

from rushline.operators import alerts as al
from rushline.operators import cleaning as cl
from rushline.plans.run import prepare
from tests.data import hourly_table

SCHEMA = ("level string, p_low double, p_medium double, p_high double, day_name string, hour int,"
          " weather_main string, weather_description string, temp_c double, holiday string")

# Contexts and the alerts they must give, word for word.
GOLDEN = [
    (("medium", 0.1, 0.8, 0.1, "Thursday", 21, "Clear", "sky is clear", 6.57, "None"),
     "Moderate traffic is expected on Thursday around 21:00 (model confidence ~80%). Expect "
     "moderate delays; standard rush-hour buffers should be sufficient."),
    (("low", 0.8, 0.1, 0.1, "Saturday", 17, "Snow", "light snow", -2.02, "None"),
     "Light traffic is expected on Saturday around 17:00 (model confidence ~80%). Wet/slick "
     "conditions (light snow) may slow traffic further. Travel times should be normal."),
    (("high", 0.05, 0.15, 0.8, "Monday", 8, "Rain", "moderate rain", 12.0, "None"),
     "Heavy traffic is expected on Monday around 08:00 (model confidence ~80%). Wet/slick "
     "conditions (moderate rain) may slow traffic further. Plan for significant delays, build "
     "in extra travel time, and consider transit or off-peak departures."),
    (("medium", 0.2, 0.6, 0.2, "Thursday", 10, "Fog", "fog", 22.0, "Thanksgiving Day"),
     "Moderate traffic is expected on Thursday around 10:00 (model confidence ~60%). Reduced "
     "visibility from fog could compound delays. Note: Thanksgiving Day may shift typical "
     "traffic patterns. Expect moderate delays; standard rush-hour buffers should be "
     "sufficient."),
    (("other", 0.85, 0.1, 0.05, "Sunday", 4, "Clear", "sky is clear", 18.0, ""),
     "Light traffic is expected on Sunday around 04:00 (model confidence ~85%). Travel times "
     "should be normal."),
]


def test_golden_alerts(spark):
    df = spark.createDataFrame([c for c, _ in GOLDEN], SCHEMA)
    assert [r[0] for r in df.select(al.alert_text()).collect()] == [a for _, a in GOLDEN]


def test_no_level_no_alert(spark):
    df = spark.createDataFrame([(None, *GOLDEN[0][0][1:])], SCHEMA)
    assert df.select(al.alert_text()).first()[0] is None


def test_prompt_and_request(spark):
    df = spark.createDataFrame([GOLDEN[2][0]], SCHEMA)
    row = df.select(al.prompt_text().alias("p"), al.request_body(al.prompt_text()).alias("b")).first()
    assert row["p"] == (
        "Prediction:\n- Predicted congestion level: high\n"
        "- Class probabilities: low=0.05, medium=0.15, high=0.80\n- Day: Monday\n- Time: 08:00\n"
        "- Weather: Rain (moderate rain)\n- Temperature: 12.0°C\n- Holiday: None\n\n"
        "Write the alert.")
    body = json.loads(row["b"])
    assert body["max_tokens"] == 256 and body["temperature"] == 0.3
    assert body["messages"] == [{"role": "user", "content": row["p"]}]
    assert body["system"].startswith("You are a concise traffic-alert writer")


@pytest.mark.parametrize("body,expected", [
    ('{"content":[{"type":"text","text":" a"},{"type":"tool"},{"text":"b\\n"}]}', "ab"),
    ('{"content":[{"text":"a"},"stray",5,null,{"text":"b"}]}', "ab"),
    ('{"content":[]}', ""),
    ('{"id":"x"}', ""),
    ("not json", None),
    (None, None),
])
def test_response_text(spark, body, expected):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(al.response_text(F.col("b"))).first()[0] == expected


def test_adhoc_contexts_get_defaults(spark):
    df = spark.createDataFrame([("high",), ("low",)], "level string")
    rows = al.with_defaults(df).select("level", al.alert_text().alias("a")).collect()
    assert rows[0]["a"].startswith(
        "Heavy traffic is expected on Monday around 08:00 (model confidence ~80%). Plan")
    partly = spark.createDataFrame([("low", None), ("low", 17)], "level string, hour int")
    texts = [r[0] for r in al.with_defaults(partly).select(al.alert_text()).collect()]
    assert "08:00" in texts[0] and "17:00" in texts[1]


def test_context_defaults_for_missing_inputs(spark):
    df = spark.createDataFrame(
        [(None, "", None, None, 9, 3, "low"), ("Fog", "dense", 1.5, "Labor Day", 1, 4, "low")],
        "weather_main string, weather_description string, temp_c double, holiday string, "
        "day_of_week int, hour int, congestion string")
    rows = al.contexts(al.constant_shares(df)).orderBy("hour").select(*al.CONTEXT).collect()
    assert tuple(rows[0]) == (
        "low", 0.8, 0.1, 0.1, "Unknown", 3, "Clear", "sky is clear", 0.0, "None")
    assert tuple(rows[1]) == (
        "low", 0.8, 0.1, 0.1, "Sunday", 4, "Fog", "dense", 1.5, "Labor Day")


def test_sample_has_one_row_per_stratum(spark):
    df = cl.add_level(cl.add_calendar(hourly_table(spark, 3_000)))
    rows = al.alert_rows(df).collect()
    assert len(rows) == 8
    assert len({(r["hour_bucket"], r["congestion"]) for r in rows}) == 8
    assert [r["datetime"] for r in rows] == sorted(r["datetime"] for r in rows)
    again = al.alert_rows(df.repartition(5)).collect()
    assert again == rows


def test_records_have_the_published_shape(spark):
    df = prepare(hourly_table(spark, 500))
    chosen = al.contexts(al.constant_shares(al.alert_rows(df)))
    record = al.alert_records(chosen).first().asDict(recursive=True)
    assert list(record) == ["datetime", "predicted_level", "context", "alert"]
    assert list(record["context"]) == list(al.CONTEXT)
