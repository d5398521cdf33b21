"""Group statistics and headline figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrade.functions.scalars import half_up, number, pad_code, rounded_mean, squared_error
from wattgrade.operators.gains import MEAN_TYPE
from wattgrade.roles import GRADES, GradeScale, Roles


def class_stats(df: DataFrame, roles: Roles) -> DataFrame:
    """Per grade: count, mean intensity, total and surface, and the sample deviation of intensity."""
    return (
        df.groupBy(roles.grade, roles.ordinal)
        .agg(
            F.count("*").alias("nb_logements"),
            rounded_mean(F.col(roles.intensity), 1).alias("conso_moy_m2"),
            rounded_mean(F.col(roles.total), 0).alias("conso_moy_totale"),
            rounded_mean(F.col(roles.surface), 1).alias("surface_moy"),
            half_up(F.stddev_samp(roles.intensity), 1).alias("conso_std"),
        )
        .orderBy(roles.ordinal)
    )


def grade_distribution(df: DataFrame, roles: Roles) -> DataFrame:
    return (
        df.groupBy(roles.grade)
        .agg(F.count("*").alias("nb"), rounded_mean(F.col(roles.intensity), 1).alias("conso_moy_kWh_m2"))
        .orderBy(roles.grade)
    )


def mean_by(
    df: DataFrame,
    by: str,
    value: str,
    name: str,
    digits: int = 1,
    descending: bool = False,
    keep_null_group: bool = False,
) -> DataFrame:
    """Mean per group, ordered by it, names breaking ties."""
    rows = df if keep_null_group else df.where(F.col(by).isNotNull())
    means = rows.groupBy(by).agg(rounded_mean(F.col(value), digits).alias(name))
    return means.orderBy(F.desc(name) if descending else F.asc(name), by)


def top_groups(df: DataFrame, by: str, value: str, name: str, n: int = 10, digits: int = 4) -> DataFrame:
    """The n groups with the highest mean: partial aggregation, then a heap of n rows per task."""
    return mean_by(df, by, value, name, digits, descending=True).limit(n)


def group_counts(df: DataFrame, by: str, name: str = "count") -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias(name)).orderBy(by)


def commune_means(consumption: DataFrame, code: str, value: str, name: str) -> DataFrame:
    """Mean of the numeric values per padded commune code."""
    return consumption.groupBy(pad_code(F.col(code)).alias(code)).agg(F.avg(number(F.col(value))).alias(name))


def group_total(df: DataFrame, by: str, name: str, approximate: bool = False) -> DataFrame:
    """Number of groups. The null group counts, as it does in a grouped table."""
    if approximate:
        null_group = F.coalesce(F.max(F.col(by).isNull().cast("int")), F.lit(0))
        return df.agg((F.approx_count_distinct(by) + null_group).alias(name))
    return df.groupBy(by).agg(F.lit(1).alias("_one")).agg(F.count("*").alias(name))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(squared_error(actual, predicted)))


def r_squared(actual: Column, predicted: Column) -> Column:
    """Share of variance explained, over the rows that have both values."""
    both = F.when(predicted.isNotNull(), actual)
    return F.lit(1.0) - F.try_divide(F.sum(squared_error(actual, predicted)), F.var_pop(both) * F.count(both))


def prediction_kpis(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("nb_logements"),
        rounded_mean(F.col(actual), 4).alias("conso_moyenne"),
        half_up(rmse(F.col(actual), F.col(predicted)), 4).alias("rmse"),
    )


def class_kpis(stats: DataFrame, roles: Roles, scale: GradeScale = GRADES) -> DataFrame:
    """Totals over the class table; the gain is 0 when the best class is missing."""

    def mean_of(label: str) -> Column:
        return F.coalesce(F.max(F.when(F.col(roles.grade) == label, F.col("conso_moy_m2"))), F.lit(0.0))

    worst, best = mean_of(scale.worst), mean_of(scale.best)
    return stats.agg(
        F.coalesce(F.sum("nb_logements"), F.lit(0)).alias("total_logements"),
        worst.alias("conso_moy_pire"),
        best.alias("conso_moy_meilleure"),
        F.when(best != 0, half_up(worst.cast(MEAN_TYPE) - best.cast(MEAN_TYPE), 0)).otherwise(F.lit(0.0)).alias("gain_total"),
    )


def axis_bound(df: DataFrame, columns: Sequence[str], name: str = "max_val") -> DataFrame:
    """Largest value over several columns."""
    return df.agg(F.greatest(*[F.max(c) for c in columns]).alias(name))


def groups_larger_than(df: DataFrame, by: str, minimum: int, name: str = "nb") -> DataFrame:
    return group_counts(df, by, name).where(F.col(name) > minimum)
