"""Profile document and report files.

The whole profile takes three scans of the table: one for the totals, one for
the cells behind every average and count, one for the hourly medians. Each
result is small and written first; tables and document are made from those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.operators import profile as pr
from rushline.sinks import write_csv, write_json, write_table
from rushline.sources import join_uri
from rushline.spec import Spec


def profile_tables(
    totals: DataFrame, cells: DataFrame, hourly: DataFrame, spec: Spec = Spec(), top_n: int = 20
) -> dict[str, DataFrame]:
    """The seven profile tables by file name."""
    def top(column: str) -> DataFrame:
        return (
            pr.from_cells(cells, column).select(column, F.col("n_records").alias("count"))
            .orderBy(F.desc("count"), F.asc(column)).limit(top_n)
        )

    return {
        "profile_numeric_summary": totals.select(F.inline("numeric_summary")),
        "profile_weather_main": top(spec.category),
        "profile_holiday": top(spec.holiday),
        "profile_hourly_volume": hourly.orderBy("hour"),
        "profile_dow_volume": pr.from_cells(cells, "dow").orderBy("dow"),
        "profile_monthly_volume":
            pr.from_cells(cells, "month").drop("n_records").orderBy("month"),
        "profile_weather_volume":
            pr.from_cells(cells, spec.category).orderBy(F.desc("avg_volume"), spec.category),
    }


def _in_order(table: DataFrame, *order: Column) -> Column:
    """A table of bounded length (calendar or top-n) as one array of structs in order."""
    row = F.struct(*[F.col(c) for c in table.columns])
    ranked = table.select(F.struct(*order).alias("rank"), row.alias("row"))
    return ranked.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "row"))), lambda x: x.getField("row"))
        .alias("rows")).scalar()


def profile_rows(totals: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Every table of the profile in long form: (section, key, name, value double).

    The form for reports of any length: one row per figure, as many as there are.
    """
    summary = tables["profile_numeric_summary"]
    statistics = [c for c in summary.columns if c != "summary"]
    parts = [
        totals.select(F.lit("totals").alias("section"), F.lit("rows").alias("key"),
                      F.lit("row_count").alias("name"), F.col("row_count").cast("double").alias("value")),
        totals.select(F.inline("null_counts")).select(
            F.lit("null_counts"), "column", F.lit("nulls"), F.col("nulls").cast("double")),
        summary.select(F.lit("numeric_summary"), "summary", F.inline(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
            for c in statistics]))),
    ]
    for name, table in tables.items():
        if name == "profile_numeric_summary":
            continue
        key, *figures = table.columns
        parts.append(table.select(F.lit(name), F.col(key).cast("string"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
            for c in figures]))))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows


def profile_document(
    schema: list[tuple[str, str]], totals: DataFrame, tables: dict[str, DataFrame],
    spec: Spec = Spec(),
) -> DataFrame:
    """The whole profile as one nested row; each part is a scalar subquery, not a join."""
    def falling(column: str, tie: str) -> list[Column]:
        return [-F.col(column), F.col(tie)]

    category, holiday = spec.category, spec.holiday
    return totals.select(
        "row_count",
        F.lit(len(schema)).alias("column_count"),
        F.array(*[
            F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"))
            for name, kind in schema
        ]).alias("schema"),
        "numeric_summary",
        F.map_from_entries("null_counts").alias("null_counts"),
        f"{spec.measure}_quantiles",
        f"{spec.temp}_quantiles",
        _in_order(tables["profile_weather_main"], *falling("count", category))
        .alias(f"{category}_distribution"),
        _in_order(tables["profile_holiday"], *falling("count", holiday))
        .alias("holiday_distribution"),
        _in_order(tables["profile_hourly_volume"], F.col("hour")).alias("hourly_volume"),
        _in_order(tables["profile_dow_volume"], F.col("dow")).alias("dow_volume"),
        _in_order(tables["profile_monthly_volume"], F.col("month")).alias("monthly_volume"),
        # One row per category, of any number: a table of its own, named here.
        F.lit("profile_weather_volume").alias("weather_volume_table"),
    )


def write_profile(df: DataFrame, out: str, spec: Spec = Spec()) -> dict[str, DataFrame]:
    """Write the seven tables, their long form and the document; returns them by name.

    The document is one row: what it holds is bounded by the calendar, the columns
    and a top-n. The table per category has as many rows as there are categories.
    """
    totals = write_table(
        pr.table_totals(df, spec.numeric, [spec.measure, spec.temp]),
        join_uri(out, "profile_totals"))
    cells = write_table(
        pr.profile_cells(df, spec.time, spec.measure, [spec.category, spec.holiday]),
        join_uri(out, "profile_cells"))
    hourly = write_table(
        pr.hourly_profile(df, spec.time, spec.measure), join_uri(out, "profile_hours"))
    tables = profile_tables(totals, cells, hourly, spec)
    for name, table in tables.items():
        # One row per category: the only table that neither the calendar nor a
        # top-n bounds, so it keeps its partitions.
        write_csv(table, join_uri(out, name), single_file=name != "profile_weather_volume")
    schema = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    write_table(profile_rows(totals, tables), join_uri(out, "profile_rows"))
    document = profile_document(schema, totals, tables, spec)
    write_json(document, join_uri(out, "profile"), single_file=True)
    written = df.sparkSession.read.schema(document.schema).json(join_uri(out, "profile"))
    return {**tables, "document": written}
