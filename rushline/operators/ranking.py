"""Numbering a whole table in an order, without a window over all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rushline.sinks import scratch_uri, write_table

# monotonically_increasing_id() holds the task in its upper bits, the row's
# place within the task in the lower 33.
PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], out: str = "number") -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... in the given order.

    The rows are dealt by ranges of the order, sorted where they lie and written
    once, with their task and place. A row's number is its place plus the rows of
    all ranges before, which are counted and summed over one row per range. Rows
    equal in the order share a range; they are numbered as they lie in it.
    """
    taken = {c.lower() for c in df.columns}
    task, place, before = (_fresh(n, taken) for n in ("task", "place", "before"))
    number = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, number)
    # one identifier in two columns: the projection above fixes it
    placed = write_table(dealt.select(
        *df.columns, F.shiftright(place, PLACE_BITS).alias(task),
        F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias(place),
    ), scratch_uri(df.sparkSession, "numbered"))
    sizes = placed.groupBy(task).agg(F.count(F.lit(1)).alias("n"))
    # one row per range of the sort, however long the table
    ahead = sizes.select(task, F.coalesce(F.sum("n").over(
        Window.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    return placed.join(ahead, task).select(
        *df.columns, (F.col(place) + F.col(before)).alias(out))


def _fresh(name: str, taken: set[str]) -> str:
    while name.lower() in taken:
        name += "_"
    taken.add(name.lower())
    return name
