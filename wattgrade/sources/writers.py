"""Batch sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_balanced(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite with controlled files: a given number, or sizes left to adaptive execution, which also splits
    an oversized partition."""
    spread = df.repartition(files) if files else df.hint("rebalance")
    spread.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Partitioned overwrite that replaces only the partitions present in ``df``.

    Rows are first brought together by the partition columns, so a directory gets few files; the rebalance splits
    a grade that holds a large share of the rows over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def replace_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Partitioned overwrite of the whole table: partitions without new rows go, as a full recompute needs."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(path)
    )


def write_extract(df: DataFrame, path: str, order: Sequence[str], n: int = 10) -> None:
    """A small CSV extract in one file; the single task only ever sees n rows."""
    df.orderBy(*order).limit(n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str, per_file: int = 0, by: Sequence[str] = ()) -> None:
    """Newline-delimited JSON; ``per_file`` limits the records per file, 0 leaves file sizes to the partitions."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", per_file)
    (writer.partitionBy(*by) if by else writer).json(path)


def write_lines(df: DataFrame, path: str, per_file: int = 200_000) -> None:
    """Lines of text, compressed. A compressed file is read by one task, so ``per_file`` bounds its lines."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def page_up(df: DataFrame, size: int = 1000, results: str = "results") -> DataFrame:
    """Rows gathered into pages of at most ``size`` records.

    A page is a run of consecutive row ids, so its size is bounded whatever the data; ids are unique, so every
    record is on exactly one page.
    """
    row_id = F.monotonically_increasing_id()
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_record")
    numbered = df.select(row_id.alias("_id"), record)
    paged = numbered.select((F.col("_id") - F.col("_id") % size).alias("page"), "_record")
    return paged.groupBy("page").agg(F.collect_list("_record").alias(results))
