"""Tables behind the figures (V2-V4, V7); drawing is left to the reader's tool."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rushline.functions import calendar as cal


def weekday_bars(weekdays: DataFrame) -> DataFrame:
    """A weekday profile with short day names and a weekend flag."""
    dow = F.col("dow")
    return weekdays.select(
        "dow",
        F.substring(cal.day_name(dow), 1, 3).alias("day"),
        "avg_volume",
        cal.weekend_flag(dow).alias("is_weekend"),
    ).orderBy("dow")


def category_bars(categories: DataFrame, category: str) -> DataFrame:
    """A category profile, quietest first."""
    return categories.select(category, "avg_volume").orderBy(
        F.asc("avg_volume"), F.asc(category))


def importance_bars(importances: DataFrame) -> DataFrame:
    """Feature importances, smallest first."""
    return importances.orderBy(F.asc("importance"), F.asc("feature"))
