"""Projections that tolerate schema drift."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.functions.scalars import number


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The listed names that exist in the frame, in list order, matched without regard to case."""
    existing = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() in existing]


def _quoted(name: str):
    return F.col(f"`{name}`")


def project_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[_quoted(n).alias(n) for n in present(df, names)])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def unwrap(df: DataFrame, column: str = "data") -> DataFrame:
    """Fields of a struct column as top-level columns; an array of structs gives one row per element."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df.select(F.inline(F.col(column)))
    return df.select(f"{column}.*")


def unwrap_if_enveloped(df: DataFrame, column: str = "data", max_outer: int | None = None) -> DataFrame:
    """Unwrap when the envelope column is there and, if a limit is given, the outer row is narrow enough."""
    if column not in df.columns or (max_outer is not None and len(df.columns) > max_outer):
        return df
    return unwrap(df, column)


def wrap(df: DataFrame, source_column: str = "source_file") -> DataFrame:
    """Envelope of file name and record; works on frames read straight from files."""
    record = F.struct(*[_quoted(c) for c in df.columns])
    return df.select(F.col("_metadata.file_name").alias(source_column), record.alias("data"))


def filled_columns(df: DataFrame) -> list[str]:
    """Names of columns with at least one value: one aggregate pass, one row to the driver."""
    flags = df.agg(*[F.count(_quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if flags[i] > 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    return df.select(*[_quoted(c) for c in filled_columns(df)])


def cast_numbers(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Listed columns as doubles where they exist; text that is no number becomes null."""
    return df.withColumns({n: number(_quoted(n)) for n in present(df, names)})


def stamp(df: DataFrame, column: str = "_silver_timestamp", source: str | None = None) -> DataFrame:
    """Audit columns: processing time and, if given, the name of the source."""
    df = df.withColumn(column, F.current_timestamp())
    return df if source is None else df.withColumn("_pipeline_source", F.lit(source))
