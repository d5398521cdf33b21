"""Exact order statistics without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattgrade.functions.scalars import number
from wattgrade.session import staged

Bracket = tuple[float, float]


def plain_number(name: str) -> Column:
    """The column as a double, with NaN counted as missing."""
    value = number(F.col(f"`{name}`"))
    return F.when(~F.isnan(value), value)


# Items a sketch keeps in its top level.
SKETCH_SIZE = 4096


def rank_error(size: int = SKETCH_SIZE) -> float:
    """The share of the rows by which a sketch's rank is off, at 99 % confidence."""
    # Published constants of the sketch's error.
    return 2.296 / size**0.9021


def bracket_edges(column: str, probabilities: Sequence[float], size: int = SKETCH_SIZE) -> Column:
    """Aggregate: values on both sides of each quantile, three times the rank error of a mergeable sketch away, or
    infinities beyond the ends and where that is less than the two rows between which a quantile may lie; null for a
    column without a value."""
    value = plain_number(column)
    n = F.count(value)
    margin = 3 * rank_error(size)
    sketch = F.kll_sketch_agg_double(value, size)
    edges = []
    for p in probabilities:
        for rank, end in ((p - margin, -math.inf), (p + margin, math.inf)):
            inner = F.kll_sketch_get_quantile_double(sketch, F.lit(min(max(rank, 0.0), 1.0)))
            edges.append(F.when((n * margin > 2) & F.lit(0 < rank < 1), inner).otherwise(end))
    return F.when(n > 0, F.array(*edges))


def brackets_of(edges: Mapping[str, Sequence[float] | None]) -> dict[str, list[Bracket]]:
    return {c: list(zip(found[::2], found[1::2], strict=True)) for c, found in edges.items() if found is not None}


def brackets_from_sketches(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[Bracket]]:
    """Value ranges that almost surely hold the quantiles, from one pass; two numbers for each reach the driver.

    They decide how much work is left, never the result.
    """
    row = df.agg(*[bracket_edges(c, probabilities).alias(f"e{i}") for i, c in enumerate(columns)]).first()
    return brackets_of({c: row[i] for i, c in enumerate(columns)})


def value_counts(
    df: DataFrame, columns: Sequence[str], brackets: Mapping[str, list[Bracket]], labels: Sequence[str] = ()
) -> DataFrame:
    """(column, value, top, label, n): counts per value inside a bracket, per gap between brackets, and per label.

    A gap is one row from its smallest to its largest value. All kinds are counted in the map tasks first, so a
    value that fills a third of a column is one row per task in the shuffle.
    """
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(None).cast("double").alias("value"),
            F.lit(None).cast("int").alias("gap"),
            F.col(f"`{name}`").cast("string").alias("label"),
        )
        for name in labels
    ]
    for name in columns:
        value = plain_number(name)
        gap = F.lit(None).cast("int")
        if name in brackets:
            inside, passed = F.lit(False), F.lit(0)
            for low, high in brackets[name]:
                inside = inside | value.between(low, high)
                passed = passed + (value > high).cast("int")
            gap = F.when(~inside, passed)
        no_label = F.lit(None).cast("string").alias("label")
        cells.append(F.struct(F.lit(name).alias("column"), value.alias("value"), gap.alias("gap"), no_label))
    long = df.select(F.inline(F.array(*cells))).where("value is not null or label is not null")
    kept = F.when(F.col("gap").isNull(), F.col("value"))
    grouped = long.groupBy("column", "gap", kept.alias("_kept"), "label")
    counted = grouped.agg(F.min("value").alias("value"), F.max("value").alias("top"), F.count("*").alias("n"))
    return counted.select("column", "value", "top", "label", "n")


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(column, q0, …, missed) from a value-count table; ``missed`` when a wanted rank lies in a gap.

    The counts are range-partitioned and written once. Slice totals, one row per slice and column, give each slice
    its first rank; only slices that hold a wanted rank are ranked row by row, and no slice is larger than one
    shuffle partition.
    """
    ranged = counts.drop("label").repartitionByRange("column", "value").withColumn("slice", F.spark_partition_id())
    table = staged(ranged, "value-counts")

    totals = table.groupBy("column", "slice").agg(F.sum("n").alias("slice_rows"))
    earlier = W.partitionBy("column").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "column",
        "slice",
        "slice_rows",
        F.coalesce(F.sum("slice_rows").over(earlier), F.lit(0)).alias("first_rank"),
        F.sum("slice_rows").over(W.partitionBy("column")).alias("total"),
    )

    positions = [F.lit(float(p)) * (F.col("total") - 1) for p in probabilities]
    wanted = [rank for position in positions for rank in (F.floor(position), F.ceil(position))]
    end = F.col("first_rank") + F.col("slice_rows")
    holds_one = F.exists(F.array(*wanted), lambda r: (r >= F.col("first_rank")) & (r < end))
    useful = offsets.where(holds_one).drop("slice_rows")

    # At most two slices per column and probability, so small whatever the data.
    hits = table.join(F.broadcast(useful), ["column", "slice"])
    upto = W.partitionBy("column", "slice").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.col("first_rank") + F.sum("n").over(upto) - 1
    ranked = hits.withColumn("last", last).withColumn("first", F.col("last") - F.col("n") + 1)

    def here(rank: Column) -> Column:
        return rank.between(F.col("first"), F.col("last"))

    picks = [F.max(F.when(here(rank), F.col("value"))).alias(f"v{i}") for i, rank in enumerate(wanted)]
    in_gap = F.exists(F.array(*[here(rank) for rank in wanted]), lambda hit: hit) & (F.col("value") < F.col("top"))
    found = ranked.groupBy("column", "total").agg(*picks, F.max(in_gap).alias("missed"))

    def interpolated(i: int) -> Column:
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        return low + (high - low) * (positions[i] - F.floor(positions[i]))

    return found.select("column", *[interpolated(i).alias(f"q{i}") for i in range(len(probabilities))], "missed")


def settled_quantiles(
    df: DataFrame, counts: DataFrame, probabilities: Sequence[float], brackets: Mapping[str, list[Bracket]]
) -> DataFrame:
    """Quantiles from value counts; a column whose bracket missed is ranked in full, from one more pass over ``df``."""
    found = quantiles_of_counts(counts, probabilities)
    if not brackets:
        return found.drop("missed")
    found = staged(found, "quantiles")
    missed = [r["column"] for r in found.where("missed").select("column").collect()]  # names of columns
    if missed:
        again = quantiles_of_counts(value_counts(df, missed, {}), probabilities)
        found = found.where(~F.col("column").isin(missed)).unionByName(again)
    return found.drop("missed")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column, q0, q1, …): exact quantiles with linear interpolation, for all columns together.

    One pass narrows each quantile down to a bracket by mergeable sketches, a second counts the values inside the
    brackets, a small share of the rows whatever their number. Ranks are counted over all rows, so a bracket that
    missed its quantile shows, and that column is ranked in full.
    """
    brackets = brackets_from_sketches(df, columns, probabilities)
    return settled_quantiles(df, value_counts(df, columns, brackets), probabilities, brackets)


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10000
) -> DataFrame:
    """Same shape from mergeable sketches: one pass, rank error at most 1/accuracy of the rows."""
    wanted = [float(p) for p in probabilities]
    sketches = [F.percentile_approx(plain_number(c), wanted, accuracy).alias(f"s{i}") for i, c in enumerate(columns)]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"s{i}")[j].alias(f"q{j}") for j in range(len(probabilities))],
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*sketches).select(F.inline(F.array(*rows)))
