"""Column profiles, correlations and densities."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.functions.scalars import half_up, rounded_mean
from wattgrade.operators.comoments import co_moments
from wattgrade.operators.ranking import (
    approx_quantiles,
    bracket_edges,
    brackets_of,
    plain_number,
    settled_quantiles,
    value_counts,
)
from wattgrade.roles import GRADES, GradeScale
from wattgrade.session import staged


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _one_row_per_column(
    df: DataFrame,
    figures: dict[str, dict[str, Column]],
    constants: dict[str, dict[str, Column]] | None = None,
    fill: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregate all figures in one pass and turn the single row into one row per column; a column without a figure
    that others have gets what ``fill`` says."""
    aggregates, rows = [], []
    for i, (name, columns) in enumerate(figures.items()):
        cells = [F.lit(name).alias("column")]
        cells += [value.alias(label) for label, value in (constants or {}).get(name, {}).items()]
        for figure, expression in columns.items():
            aggregates.append(expression.alias(f"{figure}_{i}"))
            cells.append(F.col(f"{figure}_{i}").alias(figure))
        cells += [value.alias(figure) for figure, value in (fill or {}).items() if figure not in columns]
        rows.append(F.struct(*cells))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def non_null_counts(df: DataFrame) -> DataFrame:
    return _one_row_per_column(df, {c: {"non_null": F.count(_quoted(c))} for c in df.columns})


def null_profile(df: DataFrame) -> DataFrame:
    nulls = _one_row_per_column(df, {c: {"nulls": F.count_if(_quoted(c).isNull())} for c in df.columns})
    return nulls.orderBy(F.desc("nulls"), "column")


def schema_report(df: DataFrame) -> DataFrame:
    """Name, position, type, non-null count and row count of every column."""
    figures = {c: {"non_null": F.count(_quoted(c)), "n_rows": F.count("*")} for c in df.columns}
    constants = {c: {"position": F.lit(i), "dtype": F.lit(t)} for i, (c, t) in enumerate(df.dtypes)}
    return _one_row_per_column(df, figures, constants)


def label_figures(counts: DataFrame) -> DataFrame:
    """(column, unique, top, freq) from counts per label; the smallest label wins a tie for top."""
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), "label"))
    return counts.groupBy("column").agg(
        F.count("*").alias("unique"), best["label"].alias("top"), (-best["minus_n"]).alias("freq")
    )


QUARTILES = (0.25, 0.5, 0.75)
MOMENTS = ("mean", "std", "min", "max")


def profile(df: DataFrame, exact: bool = True, digits: int = 4) -> DataFrame:
    """One row per column: labels get unique, top and freq; numbers get moments and quartiles.

    Two passes at any size: the first takes counts, moments and sketches of all columns, the second counts labels and the
    values near the quartiles. Without ``exact`` quartiles come from the first pass.
    """
    numbers = numeric_columns(df)
    labels = [c for c in df.columns if c not in numbers]
    figures = {c: {"count": F.count(_quoted(c))} for c in labels}
    for c in numbers:
        value = plain_number(c)
        means = [rounded_mean(value, digits), F.stddev_samp(value), F.min(value), F.max(value)]
        edges = bracket_edges(c, QUARTILES) if exact else F.lit(None).cast("array<double>")
        figures[c] = {"count": F.count(value), **dict(zip(MOMENTS, means, strict=True)), "edges": edges}
    empty = {f: F.lit(None).cast("double") for f in MOMENTS} | {"edges": F.lit(None).cast("array<double>")}
    first = staged(_one_row_per_column(df, figures, fill=empty), "column-figures")

    # One row for each numeric column.
    edges = {r["column"]: r["edges"] for r in first.where("edges is not null").select("column", "edges").collect()}
    brackets = brackets_of(edges)
    ranked = list(brackets)
    table = first.drop("edges")
    if labels or ranked:
        counts = staged(value_counts(df, ranked, brackets, labels), "column-counts")
    if labels:
        table = table.join(label_figures(counts.where("label is not null")), "column", "left")
    if ranked:
        quartiles = settled_quantiles(df, counts.where("label is null"), QUARTILES, brackets)
    elif numbers:
        quartiles = approx_quantiles(df, numbers, QUARTILES)
    if numbers and (ranked or not exact):
        table = table.join(quartiles.withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"}), "column", "left")
    missing = {"unique": "bigint", "top": "string", "freq": "bigint", "p25": "double", "p50": "double", "p75": "double"}
    table = table.withColumns({n: F.lit(None).cast(t) for n, t in missing.items() if n not in table.columns})
    rounded = [half_up(F.col(f), digits).alias(f) for f in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return table.select("column", "count", "unique", "top", "freq", *rounded)


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """(a, b, corr) for every ordered pair of numeric columns, over the rows where both are present.

    NaN is missing, so it leaves its row out of its column's pairs only. One pass for any number of columns; null where a
    pair has no row or a column of it does not vary over its rows.
    """
    columns = list(columns or numeric_columns(df))
    pairs = co_moments(df.select(*[plain_number(c).alias(c) for c in columns]), columns)
    spread = F.sqrt("m2_a") * F.sqrt("m2_b")
    corr = F.when(spread > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c") / spread)))
    held = pairs.select("a", "b", half_up(corr, digits).alias("corr"))
    mirrored = held.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return held.unionByName(mirrored)


# The range on which densities are shown.
DENSITY_GRID = tuple(float(x) for x in range(0, 801, 10))


def gaussian_density(
    df: DataFrame,
    grade: str,
    value: str,
    grid: Sequence[float] = DENSITY_GRID,
    minimum: int = 10,
    scale: GradeScale = GRADES,
    digits: int = 8,
    points_per_pass: int = 90,
) -> DataFrame:
    """(grade, x, density) with Scott's bandwidth, for grades with more than ``minimum`` rows.

    Bandwidths are at most one row per label of the scale, so their broadcast is bounded. The grid points are
    aggregate columns rather than joined rows: nothing is multiplied, and every task sends one row per grade. A
    pass takes at most 90 points because Spark compiles plans of up to 100 columns.
    """
    rows = df.where(scale.contains(F.col(grade)) & F.col(value).isNotNull()).select(
        F.col(grade).alias("grade"), F.col(value).cast("double").alias("v")
    )
    spread = rows.groupBy("grade").agg(F.count("*").alias("n"), F.stddev_samp("v").alias("s"))
    bandwidth = spread.where((F.col("n") > minimum) & (F.col("s") > 0)).select(
        F.col("grade").alias("_grade"), "n", (F.col("s") * F.pow(F.col("n"), F.lit(-0.2))).alias("h")
    )
    joined = rows.join(F.broadcast(bandwidth), F.col("grade") == F.col("_grade")).select(
        "grade", "n", "h", (F.col("v") / F.col("h")).alias("z"), (F.lit(1.0) / F.col("h")).alias("step")
    )

    kernel = "sum(exp(-0.5D * (z - {x:.17g}D * step) * (z - {x:.17g}D * step)))"
    parts = []
    for start in range(0, len(grid), points_per_pass):
        points = list(enumerate(grid))[start : start + points_per_pass]
        sums = joined.groupBy("grade", "n", "h").agg(*[F.expr(kernel.format(x=x)).alias(f"k{i}") for i, x in points])
        cells = [F.struct(F.lit(x).alias("x"), F.col(f"k{i}").alias("k")) for i, x in points]
        parts.append(sums.select("grade", "n", "h", F.inline(F.array(*cells))))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    density = F.col("k") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return result.select("grade", "x", half_up(density, digits).alias("density"))
