"""Alert contexts, alert text, prompts and response parsing."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.functions import calendar as cal
from rushline.functions import text
from rushline.operators.cleaning import first_of_strata
from rushline.operators.profile import TIME_FORMAT
from rushline.spec import LEVELS, Spec

# The published names and order of a context ------------------
CONTEXT = (
    "level", "p_low", "p_medium", "p_high", "day_name", "hour",
    "weather_main", "weather_description", "temp_c", "holiday",
)

# Wording of the alerts, the prompt and the request ------------
SEVERITY = {"high": "Heavy", "medium": "Moderate"}
OTHER_SEVERITY = "Light"
ADVICE = {
    "high": "Plan for significant delays, build in extra travel time, "
            "and consider transit or off-peak departures.",
    "medium": "Expect moderate delays; standard rush-hour buffers should be sufficient.",
}
OTHER_ADVICE = "Travel times should be normal."
WET = ("Rain", "Snow")
MURKY = ("Fog", "Mist", "Haze")
SYSTEM_PROMPT = (
    "You are a concise traffic-alert writer for a U.S. metropolitan area. "
    "Given a structured congestion prediction, produce a single short alert "
    "(2–3 sentences, plain English, no markdown, no preamble) that a "
    "commuter or city-traffic operator could act on. Mention the day, time, "
    "predicted level, weather context, and a brief recommendation."
)
REQUEST_VERSION = "bedrock-2023-05-31"
REQUEST_MAX_TOKENS = 256
REQUEST_TEMPERATURE = 0.3
CONTEXT_DEFAULTS = {
    "p_low": 0.1, "p_medium": 0.1, "p_high": 0.8, "day_name": "Monday", "hour": 8,
    "weather_main": "Clear", "weather_description": "sky is clear", "temp_c": 15.0,
    "holiday": "None",
}


def alert_rows(df: DataFrame, spec: Spec = Spec(), level: str = "congestion",
               n: int = 8, prefer: tuple[str, ...] = ()) -> DataFrame:
    """The first ``n`` by time among one row per (three-hour bucket, level).

    ``df`` has the calendar columns. Only the columns an alert needs go into
    the aggregate, and at most 8 x levels rows leave it, whatever the size of
    the strata.
    """
    needed = [
        spec.time, "hour", "day_of_week", spec.category, spec.detail, "temp_c", spec.holiday,
        level, *(f"p_{name}" for name in LEVELS), *prefer,
    ]
    strata = first_of_strata(
        df.select(*[c for c in dict.fromkeys(needed) if c in df.columns])
        .withColumn("hour_bucket", cal.hour_bucket(F.col("hour"))),
        ["hour_bucket", level], tuple(dict.fromkeys([*prefer, spec.time])),
    )
    return (
        strata.withColumn("datetime", F.date_format(spec.time, TIME_FORMAT))
        .orderBy("datetime", "hour_bucket", level).limit(n)
    )


def constant_shares(df: DataFrame, level: str = "congestion") -> DataFrame:
    """Level 0.8 and the others 0.1: the shares of a row that has no model score."""
    return df.withColumns({
        f"p_{name}": F.when(F.col(level) == name, 0.8).otherwise(0.1)
        for name in LEVELS
    })


def contexts(df: DataFrame, spec: Spec = Spec(), level: str = "congestion") -> DataFrame:
    """The ten context columns next to the row's own, NULL and empty texts filled in.

    ``df`` has the calendar columns and p_low/p_medium/p_high.
    """
    return df.withColumns({
        "level": F.col(level),
        "day_name": cal.day_name(F.col("day_of_week")),
        "weather_main": text.or_default(F.col(spec.category), "Clear"),
        "weather_description": text.or_default(F.col(spec.detail), "sky is clear"),
        "temp_c": F.coalesce("temp_c", F.lit(0.0)),
        "holiday": text.or_default(F.col(spec.holiday), "None"),
    })


def with_defaults(df: DataFrame) -> DataFrame:
    """An ad-hoc context table made complete; only ``level`` is required."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        for name, default in CONTEXT_DEFAULTS.items()
    })


def _by_level(level: Column, values: dict[str, str], other: str) -> Column:
    out = F.when(level.isNull(), F.lit(None).cast("string"))
    for name, value in values.items():
        out = out.when(level == name, value)
    return out.otherwise(other)


def alert_text() -> Column:
    """Plain-language alert from the context columns; NULL without a level."""
    level, weather, detail = F.col("level"), F.col("weather_main"), F.col("weather_description")
    holiday = F.col("holiday")
    weather_clause = (
        F.when(weather.isin(*WET),
               F.concat(F.lit(" Wet/slick conditions ("), detail,
                        F.lit(") may slow traffic further.")))
        .when(weather.isin(*MURKY),
              F.concat(F.lit(" Reduced visibility from "), detail,
                       F.lit(" could compound delays.")))
        .otherwise("")
    )
    holiday_clause = F.when(
        (holiday != "") & (holiday != "None"),
        F.concat(F.lit(" Note: "), holiday, F.lit(" may shift typical traffic patterns.")),
    ).otherwise("")
    return F.concat(
        _by_level(level, SEVERITY, OTHER_SEVERITY),
        F.lit(" traffic is expected on "), F.col("day_name"),
        F.lit(" around "), text.clock(F.col("hour")),
        F.lit(" (model confidence ~"),
        text.percent(F.greatest("p_low", "p_medium", "p_high")).cast("string"),
        F.lit("%)."), weather_clause, holiday_clause, F.lit(" "),
        _by_level(level, ADVICE, OTHER_ADVICE),
    )


def prompt_text() -> Column:
    """The user message describing one prediction."""
    def line(*parts) -> list[Column]:
        return [p if isinstance(p, Column) else F.lit(p) for p in parts]

    return F.concat(
        *line("Prediction:\n- Predicted congestion level: ", F.col("level")),
        *line("\n- Class probabilities: low=", text.fixed(F.col("p_low"), 2)),
        *line(", medium=", text.fixed(F.col("p_medium"), 2)),
        *line(", high=", text.fixed(F.col("p_high"), 2)),
        *line("\n- Day: ", F.col("day_name")),
        *line("\n- Time: ", text.clock(F.col("hour"))),
        *line("\n- Weather: ", F.col("weather_main")),
        *line(" (", F.col("weather_description"), ")"),
        *line("\n- Temperature: ", text.fixed(F.col("temp_c"), 1), "°C"),
        *line("\n- Holiday: ", F.col("holiday")),
        F.lit("\n\nWrite the alert."),
    )


def request_body(message: Column, max_tokens: int = REQUEST_MAX_TOKENS,
                 temperature: float = REQUEST_TEMPERATURE) -> Column:
    """JSON body of a chat request, ready for a batch-inference file.

    Only the message differs between rows; everything before it is one literal.
    """
    head = json.dumps({
        "anthropic_version": REQUEST_VERSION,
        "max_tokens": max_tokens,
        "temperature": temperature,
        "system": SYSTEM_PROMPT,
    }, ensure_ascii=False, separators=(",", ":"))
    turn = F.to_json(F.struct(F.lit("user").alias("role"), message.alias("content")))
    return F.concat(F.lit(head[:-1] + ',"messages":['), turn, F.lit("]}"))


def response_text(body: Column) -> Column:
    """The joined text blocks of a response, trimmed; NULL if it is not such a document.

    One parse reads the usual shape, a list of objects. A list that mixes in
    other values is read a second time, block by block; those values and
    objects without a text count as empty.
    """
    def parsed(block_type: str) -> Column:
        return F.from_json(body, f"content array<{block_type}>, unread string",
                           {"columnNameOfCorruptRecord": "unread"})

    def pieces(document: Column) -> Column:
        mixed = parsed("string")
        return F.when(
            document.getField("unread").isNull(),
            F.coalesce(document.getField("content").getField("text"),
                       F.array().cast("array<string>")),
        ).when(
            mixed.getField("unread").isNull(),
            F.transform(mixed.getField("content"), lambda b: F.get_json_object(b, "$.text")),
        )

    # The lambda gives the parsed document a name: written out twice, it would
    # be parsed twice.
    blocks = F.get(F.transform(F.array(parsed("struct<text string>")), pieces), F.lit(0))
    # array_join leaves NULL pieces out
    return F.when(body.isNotNull(), text.strip(F.array_join(blocks, "")))


def alert_records(df: DataFrame) -> DataFrame:
    """datetime, predicted_level, the context as a struct, and the alert."""
    return df.select(
        "datetime",
        F.col("level").alias("predicted_level"),
        F.struct(*CONTEXT).alias("context"),
        alert_text().alias("alert"),
    )
