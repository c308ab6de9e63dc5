"""Exact quantiles without gathering the column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.spec import QUANTILE_PROBS

ROUNDS = 64


@dataclass(frozen=True)
class _Interval:
    """An open interval and the wanted ranks whose values lie in it."""

    ranks: tuple[int, ...]   # 0-based among the numbers
    low: float | None        # exclusive bounds, None = unbounded
    high: float | None
    below: int               # values before the interval
    inside: int              # values in it

    @property
    def condition(self) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (F.col("v") > self.low)
        if self.high is not None:
            inside = inside & (F.col("v") < self.high)
        return inside


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float] = QUANTILE_PROBS,
    accuracy: int = 10_000,
) -> DataFrame:
    """(prob, value) with linear interpolation between neighbouring ranks.

    The built-in exact percentile keeps every distinct value of a group in one
    task. Here each round takes sketch quantiles around the wanted ranks and
    counts the rows before, at and between them: two scans of one column that
    return a handful of numbers. A rank that falls on a counted value is found;
    the others go on in the open interval between two of them, about
    2 / accuracy of the rows. A value that fills much of an interval becomes one
    of its split points, so it never stays inside. The search ends when every
    rank has met a counted value; no row is ever fetched.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(
        "v is not null and not isnan(v)")
    total = values.count()
    if total == 0:
        return _result(df, {float(p): None for p in probs})
    positions = {float(p): p * (total - 1) for p in probs}
    ranks = sorted({r for x in positions.values() for r in (math.floor(x), math.ceil(x))})
    found: dict[int, float] = {}
    intervals = [_Interval(tuple(ranks), None, None, 0, total)]
    for _ in range(ROUNDS):
        if not intervals:
            break
        intervals = _narrow(values, intervals, accuracy, found)
    else:
        raise RuntimeError(f"no answer after {ROUNDS} rounds: {intervals}")
    return _result(df, {
        p: _between(found[math.floor(x)], found[math.ceil(x)], x % 1)
        for p, x in positions.items()
    })


def _between(low: float, high: float, part: float) -> float:
    """Linear interpolation; equal neighbours, infinite ones too, are the answer."""
    if low == high or part == 0:
        return low
    return low + (high - low) * part


def _result(df: DataFrame, quantiles: dict[float, float | None]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        list(quantiles.items()), "prob double, value double")


def _narrow(values: DataFrame, intervals: list[_Interval], accuracy: int,
            found: dict[int, float]) -> list[_Interval]:
    """One round: split every interval at sketch quantiles, count, keep the pieces wanted."""
    nearby = values.filter(reduce(or_, [i.condition for i in intervals]))
    reach = 1 / accuracy
    sketches = []
    for n, i in enumerate(intervals):
        centres = [(r - i.below + 0.5) / i.inside for r in i.ranks]
        points = sorted({min(max(c + d, 0.0), 1.0) for c in centres for d in (-reach, 0, reach)})
        sketches.append(F.percentile_approx(
            F.when(i.condition, F.col("v")), points, accuracy).alias(f"s{n}"))
    splits = [sorted(set(points)) for points in nearby.agg(*sketches).first()]

    counts = []
    for n, (i, points) in enumerate(zip(intervals, splits)):
        for k, point in enumerate(points):
            counts += [
                F.count_if(i.condition & (F.col("v") < point)).alias(f"lt_{n}_{k}"),
                F.count_if(F.col("v") == point).alias(f"eq_{n}_{k}"),
            ]
    counted = nearby.agg(*counts).first()

    pieces = []
    for n, (i, points) in enumerate(zip(intervals, splits)):
        low, below, ranks = i.low, i.below, list(i.ranks)
        for k, point in enumerate(points):
            before = i.below + counted[f"lt_{n}_{k}"]
            after = before + counted[f"eq_{n}_{k}"]
            wanted = tuple(r for r in ranks if r < before)
            if wanted:
                pieces.append(_Interval(wanted, low, point, below, before - below))
            found.update({r: point for r in ranks if before <= r < after})
            ranks = [r for r in ranks if r >= after]
            low, below = point, after
        if ranks:
            pieces.append(_Interval(tuple(ranks), low, i.high, below, i.below + i.inside - below))
    return pieces
