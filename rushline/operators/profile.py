"""Profile tables (A1-A11, A13, S5): grouped aggregates with partial sums map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.spec import QUANTILE_NAMES, QUANTILE_PROBS

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _records() -> Column:
    return F.count(F.lit(1)).alias("n_records")


def _spread(packed: DataFrame) -> DataFrame:
    """The one-row table of an array of structs -> one row per element."""
    return packed.select(F.inline("rows"))


def numeric_rows(columns: Sequence[str]) -> Column:
    """Aggregate: one struct (column, count, mean, stddev, min, max) per column."""
    return F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ])


def describe_rows(columns: Sequence[str]) -> Column:
    """Aggregate: one struct per statistic, every column's value as text."""
    statistics = {
        "count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max,
    }
    return F.array(*[
        F.struct(
            F.lit(name).alias("summary"),
            *[function(c).cast("string").alias(c) for c in columns],
        )
        for name, function in statistics.items()
    ])


def null_rows(columns: Sequence[str]) -> Column:
    """Aggregate: one struct (column, nulls) per column; 0 (not NULL) on an empty table."""
    return F.array(*[
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in columns
    ])


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min and max per column, from one scan."""
    return _spread(df.agg(numeric_rows(columns).alias("rows")))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same statistics laid out one row per statistic, every cell as text."""
    return _spread(df.agg(describe_rows(columns).alias("rows")))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column in one pass."""
    return _spread(df.agg(null_rows(columns or df.columns).alias("rows")))


def category_counts(df: DataFrame, column: str, top_n: int = 20) -> DataFrame:
    """The most frequent values, ties in value order."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(column)).limit(top_n)
    )


def hourly_profile(df: DataFrame, time: str, measure: str) -> DataFrame:
    """Average, median (sketch) and row count by hour of day."""
    return (
        df.groupBy(F.hour(time).alias("hour"))
        .agg(
            F.avg(measure).alias("avg_volume"),
            F.percentile_approx(measure, 0.5).alias("median_volume"),
            _records(),
        )
        .orderBy("hour")
    )


def weekday_profile(df: DataFrame, time: str, measure: str) -> DataFrame:
    return (
        df.groupBy(F.dayofweek(time).alias("dow"))
        .agg(F.avg(measure).alias("avg_volume"), _records())
        .orderBy("dow")
    )


def monthly_profile(df: DataFrame, time: str, measure: str) -> DataFrame:
    return (
        df.groupBy(F.month(time).alias("month"))
        .agg(F.avg(measure).alias("avg_volume"))
        .orderBy("month")
    )


def category_profile(df: DataFrame, category: str, measure: str) -> DataFrame:
    """Average and row count per category, busiest first."""
    return (
        df.groupBy(category)
        .agg(F.avg(measure).alias("avg_volume"), _records())
        .orderBy(F.desc("avg_volume"), F.asc(category))
    )


def class_counts(df: DataFrame, level: str = "congestion") -> DataFrame:
    return df.groupBy(level).agg(F.count(F.lit(1)).alias("count")).orderBy(level)


def approx_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = QUANTILE_PROBS,
    relative_error: float = 0.001,
) -> DataFrame:
    """Quantiles of several columns from one scan, as (column, prob, value).

    The rank error of each value is at most ``relative_error`` of the rows; the
    sketch stays small however long the column is.
    """
    values = [
        F.percentile_approx(F.col(c).cast("double"), list(probs), round(1 / relative_error))
        for c in columns
    ]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(float(p)).alias("prob"),
            F.get(v, F.lit(i)).alias("value"),
        )
        for c, v in zip(columns, values) for i, p in enumerate(probs)
    ])
    return _spread(df.agg(rows.alias("rows")))


def quantile_struct(column: str, relative_error: float = 0.001) -> Column:
    """p05..p95 of one column as an aggregate returning a struct."""
    values = F.percentile_approx(
        F.col(column).cast("double"), list(QUANTILE_PROBS), round(1 / relative_error)
    )
    return F.struct(*[F.get(values, F.lit(i)).alias(n) for i, n in enumerate(QUANTILE_NAMES)])


def load_summary(df: DataFrame, time: str, source: str) -> DataFrame:
    """Rows, columns, first and last time as text, and where the rows came from."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.date_format(F.min(time), TIME_FORMAT).alias("date_range_start"),
        F.date_format(F.max(time), TIME_FORMAT).alias("date_range_end"),
        F.lit(source).alias("source"),
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """Name and type of every column, in order."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def table_totals(
    df: DataFrame, numeric: Sequence[str], quantile_columns: Sequence[str]
) -> DataFrame:
    """Everything the profile says about the whole table, as one row from one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        describe_rows(numeric).alias("numeric_summary"),
        null_rows(df.columns).alias("null_counts"),
        *[quantile_struct(c).alias(f"{c}_quantiles") for c in quantile_columns],
    )


CALENDAR = ("hour", "dow", "month")


def profile_cells(
    df: DataFrame, time: str, measure: str, categories: Sequence[str]
) -> DataFrame:
    """Sums and counts, as (part, calendar columns, categories, total, n_values, n_records).

    One grouping set for the calendar (at most 24 * 7 * 12 cells) and one for each
    category, so the cells grow with the sum of the categories, not their product.
    ``part`` names the set. Rows fold inside the map tasks: a busy value costs
    nothing extra.
    """
    calendar = {"hour": F.hour(time), "dow": F.dayofweek(time), "month": F.month(time)}
    keyed = df.select(
        *[c.alias(n) for n, c in calendar.items()], *dict.fromkeys(categories),
        F.col(measure).alias("_measure"))
    keys = [*CALENDAR, *dict.fromkeys(categories)]
    sets = [list(CALENDAR), *[[c] for c in dict.fromkeys(categories)]]
    # grouping_id reads left to right: the cleared bits mark the grouped columns.
    ids = {sum(0 if k in s else 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)): s
           for s in sets}
    name = F.create_map(*[
        x for i, s in ids.items()
        for x in (F.lit(i).cast("bigint"), F.lit("calendar" if len(s) > 1 else s[0]))])
    return keyed.groupingSets(
        [[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys],
    ).agg(
        name[F.grouping_id()].alias("part"),
        F.sum("_measure").alias("total"),
        F.count("_measure").alias("n_values"),
        _records(),
    )


def from_cells(cells: DataFrame, key: str) -> DataFrame:
    """avg_volume and n_records by one key of the cells."""
    part = "calendar" if key in CALENDAR else key
    return cells.filter(F.col("part") == part).groupBy(key).agg(
        F.try_divide(F.sum("total"), F.sum("n_values")).alias("avg_volume"),
        F.sum("n_records").alias("n_records"),
    )


def profile_suite(
    df: DataFrame, time: str, measure: str, categories: Sequence[str]
) -> DataFrame:
    """Hour, weekday, month and category averages together, from one scan.

    Output: (dimension, value, avg_volume, n_records), one block per dimension,
    unfolded from the cells.
    """
    cells = profile_cells(df, time, measure, categories)
    own = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
           for d in CALENDAR]
    of_category = F.create_map(*[
        x for c in dict.fromkeys(categories) for x in (F.lit(c), F.col(c).cast("string"))])
    blocks = F.when(F.col("part") == "calendar", F.array(*own)).otherwise(F.array(F.struct(
        F.col("part").alias("dimension"), of_category[F.col("part")].alias("value"))))
    return cells.select(F.inline(blocks), "total", "n_values", "n_records").groupBy(
        "dimension", "value").agg(
        F.try_divide(F.sum("total"), F.sum("n_values")).alias("avg_volume"),
        F.sum("n_records").alias("n_records"))
