"""Class means and the gains between grades.

The class table has one row per label of the scale, so it and everything derived from it (at most one row per pair of
labels) is bounded by the scale itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.functions.scalars import half_up, rounded_mean, safe_ratio, step_label
from wattgrade.roles import GRADES, GradeScale, Roles

MEAN_TYPE = T.DecimalType(18, 1)


def class_means(df: DataFrame, roles: Roles, scale: GradeScale = GRADES) -> DataFrame:
    """(grade, ord, conso): mean intensity per label of the scale, as a decimal with one digit."""
    grade = F.col(roles.grade)
    return (
        df.where(scale.contains(grade))
        .groupBy(grade.alias("grade"))
        .agg(rounded_mean(F.col(roles.intensity), 1).cast(MEAN_TYPE).alias("conso"))
        .select("grade", scale.ordinal(F.col("grade")).alias("ord"), "conso")
    )


def better_pairs(means: DataFrame) -> DataFrame:
    """Every (source, strictly better target) pair for which both classes exist.

    All classes are gathered into one array, at most one entry per label, and each class picks the entries
    before its own, so the means are computed once instead of once per side of a self-join.
    """
    entry = F.struct("ord", "grade", "conso")
    ladder = means.agg(F.array_sort(F.collect_list(entry)).alias("classes"))
    source = ladder.select("classes", F.explode("classes").alias("s"))
    target = source.select("s", F.explode(F.filter("classes", lambda c: c["ord"] < F.col("s.ord"))).alias("t"))
    return target.select(
        F.col("s.grade").alias("classe_origine"),
        F.col("t.grade").alias("classe_cible"),
        F.col("s.ord").alias("ord_origine"),
        F.col("t.ord").alias("ord_cible"),
        F.col("s.conso").alias("conso_origine"),
        F.col("t.conso").alias("conso_cible"),
    )


def gain_matrix(means: DataFrame) -> DataFrame:
    """Target mean minus source mean as a whole number; negative is a saving."""
    gain = F.round(F.col("conso_cible") - F.col("conso_origine"), 0).cast("double")
    return better_pairs(means).select("classe_origine", "classe_cible", gain.alias("gain_kWh_m2"))


def gain_ladder(means: DataFrame) -> DataFrame:
    """One step to the next better grade: source mean minus target mean; positive is a saving."""
    steps = better_pairs(means).where(F.col("ord_origine") == F.col("ord_cible") + 1)
    gain = F.col("conso_origine") - F.col("conso_cible")
    # Decimals small enough that the quotient keeps twelve digits, more than any tie of one-digit means needs.
    share = safe_ratio(gain.try_cast(T.DecimalType(12, 1)) * 100, F.col("conso_origine").try_cast(T.DecimalType(10, 1)))
    return steps.select(
        step_label(F.col("classe_origine"), F.col("classe_cible")).alias("saut"),
        "classe_origine",
        "classe_cible",
        gain.cast("double").alias("gain_kWh_m2"),
        half_up(share, 1).alias("gain_pct"),
    )


def ranked_ladder(means: DataFrame) -> DataFrame:
    return gain_ladder(means).orderBy(F.desc("gain_kWh_m2"), "saut")


def lookup_step(means: DataFrame, source: str, target: str) -> DataFrame:
    """The chosen pair, or no row when the target is not strictly better or a class is missing."""
    gain = F.col("conso_origine").cast("double") - F.col("conso_cible").cast("double")
    return (
        better_pairs(means)
        .where((F.col("classe_origine") == source) & (F.col("classe_cible") == target))
        .select(
            "classe_origine",
            "classe_cible",
            F.col("conso_origine").cast("double").alias("conso_avant"),
            F.col("conso_cible").cast("double").alias("conso_apres"),
            gain.alias("gain_m2"),
        )
    )
