"""Row rules, de-duplication and the cleaning report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattgrade.operators.shaping import cast_numbers, drop_empty_columns, present
from wattgrade.roles import GRADES, GradeScale, Roles

# Accepted ranges of the class analysis and the upper limit of the model target.
INTENSITY_RANGE = (0.0, 2000.0)
SURFACE_RANGE = (9.0, 1000.0)
TARGET_LIMIT = 2000.0


def all_present(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def in_ranges(roles: Roles) -> Column:
    """Closed ranges on intensity and surface."""
    return F.col(roles.intensity).between(*INTENSITY_RANGE) & F.col(roles.surface).between(*SURFACE_RANGE)


def in_target_range(roles: Roles, limit: float = TARGET_LIMIT) -> Column:
    """Open range on the model target."""
    target = F.col(roles.intensity)
    return target.isNotNull() & (target > 0) & (target < limit)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    return df.dropna("all")


def drop_incomplete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct. Copies are merged within each map task before the shuffle, so a hot row costs little."""
    return df.dropDuplicates()


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, which must list every other column so that ties cannot matter.

    Spark turns the ``= 1`` on the row number into a group limit that also runs before the shuffle, so a key with
    any share of the rows reaches the reducer as at most one row per map task.
    """
    latest_first = W.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    numbered = df.withColumn("_position", F.row_number().over(latest_first))
    return numbered.where(F.col("_position") == 1).drop("_position")


def clean_dataset(df: DataFrame) -> DataFrame:
    """Blank rows, empty columns and repeated rows removed."""
    return distinct_rows(drop_empty_columns(drop_blank_rows(df)))


def row_rules(df: DataFrame, roles: Roles, scale: GradeScale = GRADES) -> DataFrame:
    """The stateless part of the class-analysis clean; also runs on a stream."""
    typed = cast_numbers(df, roles.numbers)
    kept = typed.where(
        all_present(present(df, roles.required)) & scale.contains(F.col(roles.grade)) & in_ranges(roles)
    )
    return kept.withColumn(roles.ordinal, scale.ordinal(F.col(roles.grade)))


def clean_for_classes(df: DataFrame, roles: Roles, scale: GradeScale = GRADES) -> DataFrame:
    """One row per key, then the row rules: the order matters, the survivor is chosen before any rule drops it."""
    typed = cast_numbers(df, roles.numbers)
    return row_rules(latest_per_key(typed, roles.key, roles.survivor_order(df.columns)), roles, scale)


def cleaning_report(df: DataFrame, roles: Roles, scale: GradeScale = GRADES) -> DataFrame:
    """Rows before, removed by each rule in turn, and after.

    The survivors are judged as in the clean itself. The rows before are a plain count, for which a columnar scan
    reads no column, so both halves together cost little more than the clean.
    """
    typed = cast_numbers(df, roles.numbers)
    survivors = latest_per_key(typed, roles.key, roles.survivor_order(typed.columns))
    complete = all_present(roles.required)
    graded = F.coalesce(scale.contains(F.col(roles.grade)), F.lit(False))
    ranged = F.coalesce(in_ranges(roles), F.lit(False))
    none = F.lit(0).cast("bigint")
    judged = survivors.agg(
        none.alias("rows_before"),
        F.count("*").alias("keys"),
        F.count_if(~complete).alias("removed_incomplete"),
        F.count_if(complete & ~graded).alias("removed_off_scale"),
        F.count_if(complete & graded & ~ranged).alias("removed_out_of_range"),
        F.count_if(complete & graded & ranged).alias("rows_after"),
    )
    total = df.agg(F.count("*").alias("rows_before")).select(
        "rows_before", *[none.alias(c) for c in judged.columns[1:]]
    )
    sums = total.union(judged).agg(*[F.sum(c).alias(c) for c in judged.columns])
    return sums.select(
        "rows_before",
        (F.col("rows_before") - F.col("keys")).alias("removed_repeated_key"),
        "removed_incomplete",
        "removed_off_scale",
        "removed_out_of_range",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
    )


def dataset_report(df: DataFrame) -> DataFrame:
    """Rows before, blank rows, repeated rows and rows after for the full-row clean, from one pass."""
    blank = ~reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in df.columns])
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_copies"))
    copies = F.col("_copies")
    return groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(blank, copies)), F.lit(0)).alias("removed_blank"),
        F.coalesce(F.sum(F.when(~blank, copies - 1)), F.lit(0)).alias("removed_repeated"),
        F.count_if(~blank).alias("rows_after"),
    )
