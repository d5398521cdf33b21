"""Cells of training rows that no tree can tell apart.

A tree cuts a number only between its bins, so rows of the same labels and bins go the same way through every tree. For
squared errors the number of rows and their mean target say all about a cell that a boosted tree asks: the errors inside
a cell are the same on either side of a cut. There are at most as many cells as labels and bins make, and never more than
rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrade.functions.scalars import number, rounded_mean
from wattgrade.operators.ranking import quantiles_of_counts, value_counts
from wattgrade.session import staged

ROWS, DRAW = "_rows", "_draw"
# Digits behind the point of a cell's mean target.
DIGITS = 15
# Quantiles that one query looks for.
AT_ONCE = 64


def _number(name: str) -> Column:
    return number(F.col(f"`{name}`"))


def _finite(value: Column) -> Column:
    return F.abs(value) < math.inf  # NaN is larger


def _spread(counts: DataFrame, n: int) -> list[float]:
    """The middle values of n equal shares of the rows."""
    shares = [(i + 0.5) / n for i in range(n)]
    found = []
    for at in range(0, n, AT_ONCE):
        part = shares[at : at + AT_ONCE]
        row = quantiles_of_counts(counts, part).first()
        found += [row[f"q{i}"] for i in range(len(part))] if row else []
    return found


def bin_values(df: DataFrame, column: str, bins: int) -> list[float]:
    """One value for each bin of the column, in order: all its values if they are no more than the bins, else exact
    quantiles over all rows. Values that fill more than a share are set apart first, so the rest still gets its bins.
    Beside them at most one value more reaches the driver."""
    value = F.when(_finite(_number(column)), _number(column))
    counts = staged(value_counts(df.select(value.alias("v")), ["v"], {}), "bin-counts")
    few = [r["value"] for r in counts.select("value").limit(bins + 1).collect()]
    if len(few) <= bins:
        return sorted(few)
    share = counts.agg(F.sum("n")).first()[0] / bins
    heavy = [r["value"] for r in counts.where(F.col("n") > share).select("value").collect()]  # fewer than the bins
    found = {*heavy, *_spread(counts.where(F.col("n") <= share), bins - len(heavy))}
    return sorted(found | {0.0} if min(found) < 0 < max(found) else found)


def snapped(value: Column, values: Sequence[float]) -> Column:
    """The nearest of the values. Trees cut in the middle between two of them, and a number there goes to the left, so a
    number and what it is snapped to pass every cut on the same side."""
    if not values:
        return value
    nearest = F.lit(values[-1])
    for low, high in reversed(list(zip(values, values[1:]))):
        nearest = F.when(value <= (low + high) / 2.0, low).otherwise(nearest)
    return F.when(_finite(value), nearest).otherwise(value)


def cells_of(
    rows: DataFrame,
    target: str,
    categoricals: Sequence[str],
    numerics: Sequence[str],
    bins: int,
    draws: int = 1,
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per cell: its labels and numbers, how many rows it has, and their mean target.

    Two bins are left to the trees, which may count a zero among a column's values that is none of them. A mean is the
    same for every order of the rows; null where a target is null, which no tree learns from. More than one of ``draws``
    cuts each cell into as many parts at most by the hash of the ``keys``, for trees that draw what they learn from;
    ``DRAW`` is the part's number.
    """
    numbers = [snapped(_number(c), bin_values(rows, c, bins - 2)).alias(c) for c in numerics]
    named = [f"`{c}`" for c in categoricals]
    goal = F.col(f"`{target}`")
    mean = F.when(F.count(goal) == F.count("*"), rounded_mean(goal, DIGITS))
    by = [*named, *[f"`{c}`" for c in numerics]]
    if draws > 1:
        numbers.append(F.pmod(F.xxhash64(*[f"`{k}`" for k in keys]), F.lit(draws)).alias(DRAW))
        by.append(DRAW)
    grouped = rows.select(*[F.col(c) for c in named], *numbers, goal).groupBy(*by)
    return grouped.agg(F.count("*").cast("double").alias(ROWS), mean.alias(target))


def at_least(cells: DataFrame, n: int) -> DataFrame:
    """The cells, each in as many equal parts as n rows need: trees take no more labels than they are given rows."""
    parts = -(-n // max(cells.count(), 1))
    if parts == 1:
        return cells
    whole = cells.withColumn(ROWS, F.col(ROWS) / parts)
    return whole.select("*", F.explode(F.array_repeat(F.lit(0), parts)).alias("_part")).drop("_part")
