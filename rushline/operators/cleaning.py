"""Duplicate removal, fault filter and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rushline.functions import calendar as cal
from rushline.spec import Spec


def distinct_on(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by the other columns.

    NULLs sort first and NULL keys form one group. The whole row travels once,
    as a struct ordered by ``prefer``, inside a ``min`` aggregate: every map
    task sends at most one row per key, so a key that holds a third of the
    table costs its reducer one row per task, and no group is ever gathered.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = list(prefer) + [c for c in rest if c not in prefer]
    if not ordered:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
    return picked.select(*[
        F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns
    ])


def first_of_strata(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str]
) -> DataFrame:
    """``distinct_on`` for few groups of many rows, led by a fixed-width column.

    The least lead of each group comes from a hash aggregate that sorts nothing;
    only rows that hold it go on to the whole-row minimum. A NULL lead is least.
    """
    lead, keys = prefer[0], list(keys)
    least = df.groupBy(*keys).agg(
        F.min(lead).alias("_least"), F.bool_or(F.col(lead).isNull()).alias("_has_null"))
    least = least.select(
        F.struct(*keys).alias("_group"),
        F.when(~F.col("_has_null"), F.col("_least")).alias("_least"))
    same = F.struct(*[df[k] for k in keys]).eqNullSafe(F.col("_group")) & df[lead].eqNullSafe(
        F.col("_least"))
    return distinct_on(df.join(least, same, "left_semi"), keys, prefer)


def drop_faults(df: DataFrame, column: str, above: float) -> DataFrame:
    """Rows whose reading is above the fault threshold; NULL readings go."""
    return df.filter(F.col(column) > above)


def clean(df: DataFrame, spec: Spec = Spec(), prefer: Sequence[str] = (),
          filter_first: bool = False) -> DataFrame:
    """One row per time, without sensor faults.

    The default order is dedupe, then filter: a faulty row may win its hour and
    the hour is then lost. ``filter_first`` keeps such hours and lets the
    filter reach the scan.
    """
    if filter_first:
        return distinct_on(drop_faults(df, spec.temp, spec.min_temp), [spec.time], prefer)
    return drop_faults(distinct_on(df, [spec.time], prefer), spec.temp, spec.min_temp)


def add_calendar(df: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """hour, day_of_week, month, is_weekend, season, is_holiday, temp_c in one projection."""
    time = F.col(spec.time)
    return df.withColumns({
        "hour": F.hour(time),
        "day_of_week": F.dayofweek(time),
        "month": F.month(time),
        "is_weekend": cal.weekend_flag(F.dayofweek(time)),
        "season": cal.season(F.month(time)),
        "is_holiday": cal.holiday_flag(
            F.col(spec.holiday), spec.no_holiday, spec.null_is_holiday),
        "temp_c": cal.celsius(F.col(spec.temp)),
    })


def add_derived(df: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """The calendar columns under the spec's holiday options."""
    derived = add_calendar(df, spec)
    return spread_holidays(derived, spec) if spec.whole_day_holidays else derived


def add_level(df: DataFrame, spec: Spec = Spec(), out: str = "congestion") -> DataFrame:
    return df.withColumn(out, cal.level(F.col(spec.measure), spec.low_max, spec.high_min))


def spread_holidays(df: DataFrame, spec: Spec = Spec(), out: str = "is_holiday") -> DataFrame:
    """Flag every row of a day on which any row is a holiday.

    The right side is one date per holiday; Spark picks the join by its size.
    """
    day = F.to_date(F.col(spec.time))
    is_holiday = cal.holiday_flag(
        F.col(spec.holiday), spec.no_holiday, spec.null_is_holiday) == 1
    days = df.filter(is_holiday).select(day.alias("_day")).distinct()
    return (
        df.drop(out).withColumn("_day", day)
        .join(days.withColumn("_hit", F.lit(1)), "_day", "left")
        .withColumn(out, F.coalesce("_hit", F.lit(0)))
        .drop("_day", "_hit")
    )
