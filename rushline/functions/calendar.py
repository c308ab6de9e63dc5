"""Calendar, flag and bucket columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rushline.spec import KELVIN_OFFSET

# Day numbers as ``dayofweek`` gives them.
DAY_NAMES = {
    1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday",
    5: "Thursday", 6: "Friday", 7: "Saturday",
}


def weekend_flag(day_of_week: Column) -> Column:
    """1 on Saturday and Sunday, else 0 (NULL day: 0)."""
    return F.when(day_of_week.isin(1, 7), 1).otherwise(0)


def season(month: Column) -> Column:
    """Meteorological season; a NULL month falls to the last branch, fall."""
    quarter = F.floor(month % 12 / 3)
    return (
        F.when(quarter == 0, "winter").when(quarter == 1, "spring")
        .when(quarter == 2, "summer").otherwise("fall")
    )


def holiday_flag(holiday: Column, none: str = "None", null_is_holiday: bool = True) -> Column:
    """0 where the text is the "no holiday" marker, else 1."""
    flag = F.when(holiday == none, 0)
    if not null_is_holiday:
        flag = flag.when(holiday.isNull(), 0)
    return flag.otherwise(1)


def celsius(kelvin: Column) -> Column:
    return kelvin - KELVIN_OFFSET


def hour_bucket(hour: Column, width: int = 3) -> Column:
    return F.floor(hour / width)


def day_name(day_of_week: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in DAY_NAMES.items() for x in pair])
    return F.coalesce(names[day_of_week], F.lit("Unknown"))


def level(measure: Column, low_max: float, high_min: float) -> Column:
    """Three-way bucket; both bounds are inclusive, a NULL measure is medium."""
    return (
        F.when(measure <= low_max, "low").when(measure >= high_min, "high").otherwise("medium")
    )


def level_index(level_col: Column, labels: tuple[str, ...]) -> Column:
    """Position of a level in a fixed label list as double; unknown levels fail.

    The list is fixed rather than learned, so a split that lacks a class keeps
    the same indices.
    """
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), level_col)
    return F.when(position > 0, (position - 1).cast("double")).when(
        level_col.isNotNull(),
        F.raise_error(F.concat(F.lit("unknown level: "), level_col)).cast("double"),
    )
