"""Indexes of labels that never pass through the driver: a frequency table, numbered in place, joined back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattgrade.session import staged


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def numbered_within(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Rows numbered from 0 inside each group, in the given order, without a group in one task.

    The rows are sorted over all tasks and written once. A group's rows follow one another there, so a row's number is
    its place in its task's share plus the shares before; one row per task and group tells these, so their number is
    that of the tasks and groups together at most, and they go to every task instead of the rows to them.
    """
    placed = staged(
        df.sort(group, *order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name
    )
    shares = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    shares = shares.select(F.col(group).alias("_group"), F.col("_part").alias("_share"), shift)
    same = (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_part") == F.col("_share"))
    return placed.join(F.broadcast(shares), same).withColumn(name, F.col("_at") + F.col("_shift")).select(*df.columns, name)


def label_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, n, idx) of all labels of the columns: by falling frequency, then by name. Nulls are no label.

    Labels are counted in each task before they are shuffled, so a frequent one costs one row a task.
    """
    cells = [F.struct(F.lit(c).alias("column"), _quoted(c).cast("string").alias("label")) for c in columns]
    counts = df.select(F.inline(F.array(*cells))).where("label is not null").groupBy("column", "label")
    return numbered_within(
        counts.agg(F.count("*").alias("n")), "column", [F.desc("n"), F.asc("label")], "idx"
    ).withColumn("idx", F.col("idx").cast("int"))


def label_sizes(table: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Labels of each column; one row per column reaches the driver."""
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return {c: found.get(c, 0) for c in columns}


def with_label_ranks(df: DataFrame, table: DataFrame, columns: Sequence[str], suffix: str = "_rank") -> DataFrame:
    """Adds each column's index as a double; null and unseen labels get the number after the last.

    How a table is joined is Spark's choice by its size; adaptive execution splits a label that holds a large share.
    """
    for c, size in label_sizes(table, columns).items():
        found = table.where(F.col("column") == c).select(F.col("label").alias("_label"), F.col("idx").alias("_idx"))
        joined = df.join(found, _quoted(c).cast("string") == F.col("_label"), "left")
        rank = F.coalesce(F.col("_idx"), F.lit(size)).cast("double").alias(f"{c}{suffix}")
        df = joined.select(*[_quoted(k) for k in df.columns], rank)
    return df
