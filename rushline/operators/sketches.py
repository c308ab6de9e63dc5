"""Kept quantile sketches, merged for any range of periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.spec import QUANTILE_PROBS

#: Size parameter of a KLL sketch: its rank error is about 1.65 % at 200 and 0.3 % at
#: 1,600, whatever the number of values.
K = 1600


def rank_error(k: int = K) -> float:
    """The normalised rank error of one quantile at 99 % confidence (published for KLL)."""
    return 2.296 / k ** 0.9723


def period_sketches(df: DataFrame, period: Column, columns: Sequence[str], k: int = K) -> DataFrame:
    """One row per period and column: (period, column, n, lowest, highest, sketch).

    Sketches fold in the map tasks: a period that holds a third of the rows costs
    one sketch a task. The table is small and lasts: quantiles of any range of
    periods, by any later job, come from it and not from the rows.
    """
    folded = df.groupBy(period.alias("period")).agg(*[
        x for i, c in enumerate(columns) for x in (
            F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"sketch{i}"),
            F.count(c).alias(f"n{i}"), F.min(F.col(c).cast("double")).alias(f"lowest{i}"),
            F.max(F.col(c).cast("double")).alias(f"highest{i}"))])
    parts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"),
                 F.col(f"lowest{i}").alias("lowest"), F.col(f"highest{i}").alias("highest"),
                 F.col(f"sketch{i}").alias("sketch"))
        for i, c in enumerate(columns)])
    return folded.select("period", F.inline(parts)).where(F.col("n") > 0)


def range_quantiles(
    sketches: DataFrame, probs: Sequence[float] = QUANTILE_PROBS, by: Sequence[str | Column] = (),
) -> DataFrame:
    """Quantiles of the merged sketches: (by..., column, n, lowest, highest, prob, value).

    ``by`` groups periods into ranges (months, years); none is one range of all.
    """
    merged = sketches.groupBy(*by, "column").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"),
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))
    names = merged.columns[:-4]
    wanted = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"),
                 F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
        for p in probs])
    return merged.select(*names, "n", "lowest", "highest", F.inline(wanted))
