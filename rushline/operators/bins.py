"""Equal-width and hexagonal bins.

Ranges come from a one-row aggregate used as a scalar subquery, so rows are
binned by a plain projection: no join, and only bin counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _range(df: DataFrame, *columns: str) -> Column:
    """min/max of the columns as one scalar struct: fields lo_<i>, hi_<i>."""
    bounds = []
    for i, c in enumerate(columns):
        bounds += [
            F.min(c).cast("double").alias(f"lo_{i}"),
            F.max(c).cast("double").alias(f"hi_{i}"),
        ]
    return df.agg(*bounds).select(F.struct("*")).scalar()


def _number(column: str) -> Column:
    """True for values that have a place on the axis: neither NULL nor NaN."""
    return F.col(column).isNotNull() & ~F.isnan(F.col(column))


def histogram(
    df: DataFrame,
    column: str,
    bins: int = 50,
    low_max: float | None = None,
    high_min: float | None = None,
) -> DataFrame:
    """Counts of equal-width bins, the last one closed, empty bins included.

    A constant column gets the unit range around its value. ``low_max`` and
    ``high_min`` mark the bins the level bounds fall into.
    """
    df = df.filter(_number(column))
    bounds = _range(df, column)
    lo, hi = bounds.getField("lo_0"), bounds.getField("hi_0")
    flat = lo == hi
    start = F.when(flat, lo - 0.5).otherwise(lo)
    width = F.when(flat, 1.0).otherwise(hi - lo) / bins
    value = F.col(column).cast("double")
    place = F.least(F.floor((value - start) / width), F.lit(bins - 1)).cast("int")
    counts = df.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    lower, upper = start + F.col("bin") * width, start + (F.col("bin") + 1) * width
    out = (
        # counts has at most one row per bin
        axis.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin", lower.alias("lower"), upper.alias("upper"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        )
    )
    if low_max is not None and high_min is not None:
        def holds(bound: float) -> Column:
            last = F.col("bin") == bins - 1
            return (F.lit(bound) >= F.col("lower")) & (
                (F.lit(bound) < F.col("upper")) | (last & (F.lit(bound) <= F.col("upper")))
            )
        out = out.withColumns({
            "has_low_max": holds(float(low_max)).cast("int"),
            "has_high_min": holds(float(high_min)).cast("int"),
        })
    return out


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 40) -> DataFrame:
    """Counts per hexagon, empty ones dropped (two offset lattices, nearest centre).

    ``gridsize`` columns and ``gridsize / sqrt(3)`` rows over the value ranges
    (Carr, Olsen and White 1992). Lattice 0 has its centres on whole cells,
    lattice 1 half a cell further in both directions; a tie goes to lattice 1.
    """
    rows = int(gridsize / 3 ** 0.5)
    df = df.filter(_number(x) & _number(y))
    bounds = _range(df, x, y)

    def axis(i: int, cells: int) -> tuple[Column, Column]:
        lo, hi = bounds.getField(f"lo_{i}"), bounds.getField(f"hi_{i}")
        return lo, F.when(hi > lo, hi - lo).otherwise(1.0) / cells

    (x0, dx), (y0, dy) = axis(0, gridsize), axis(1, rows)
    u, v = (F.col(x) - x0) / dx, (F.col(y) - y0) / dy
    placed = (
        df.select(u.alias("u"), v.alias("v"))
        .withColumns({
            "u0": F.rint("u"), "v0": F.rint("v"),
            # the largest value belongs to the last cell, not to one beyond it
            "u1": F.least(F.floor("u"), F.lit(gridsize - 1)) + 0.5,
            "v1": F.least(F.floor("v"), F.lit(rows - 1)) + 0.5,
        })
    )

    def distance(cu: str, cv: str) -> Column:
        # rows are sqrt(3) times as far apart as columns
        return F.pow(F.col("u") - F.col(cu), 2) + 3 * F.pow(F.col("v") - F.col(cv), 2)

    whole = distance("u0", "v0") < distance("u1", "v1")
    return (
        placed.groupBy(
            F.when(whole, 0).otherwise(1).alias("lattice"),
            F.when(whole, F.col("u0")).otherwise(F.col("u1")).alias("cu"),
            F.when(whole, F.col("v0")).otherwise(F.col("v1")).alias("cv"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "lattice",
            (F.col("cu") * dx + x0).alias("center_x"),
            (F.col("cv") * dy + y0).alias("center_y"),
            "n",
        )
    )
