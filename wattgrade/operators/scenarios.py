"""Renovation scenarios: every dwelling with every better grade it could reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrade.functions.scalars import half_up, safe_ratio
from wattgrade.operators.gains import MEAN_TYPE, better_pairs
from wattgrade.roles import CLASS_REFERENCE, GRADES, GradeScale, Roles

# Default rates of the two scenario forms.
CLASS_PRICE_PER_KWH = 0.25
CARBON_PER_KWH = 0.035
REFERENCE_PRICE_PER_KWH = 0.23
WORKS_COST = 15000.0


def reference_classes(spark: SparkSession, scale: GradeScale = GRADES) -> DataFrame:
    """(grade, ord, conso) from the published class table."""
    rows = [(grade, scale.labels.index(grade) + 1, conso) for grade, conso in CLASS_REFERENCE]
    table = spark.createDataFrame(rows, "grade string, ord int, conso double")
    return table.withColumn("conso", F.col("conso").cast(MEAN_TYPE))


def better_targets(df: DataFrame, classes: DataFrame, roles: Roles) -> DataFrame:
    """Each row joined to its strictly better target grades.

    The pair table is bounded by the scale (21 rows for seven grades), which is what makes the broadcast safe; the
    join is an equality on the grade, so no row meets a class it cannot use.
    """
    pairs = better_pairs(classes).select(
        F.col("classe_origine").alias("_source"),
        "classe_cible",
        F.col("conso_origine").cast("double").alias("c_avant"),
        F.col("conso_cible").cast("double").alias("c_apres"),
    )
    return df.join(F.broadcast(pairs), F.col(roles.grade) == F.col("_source")).drop("_source")


def class_savings(
    df: DataFrame,
    classes: DataFrame,
    roles: Roles,
    price: float = CLASS_PRICE_PER_KWH,
    carbon: float = CARBON_PER_KWH,
) -> DataFrame:
    """Savings from the measured class means: kWh per year, money and carbon."""
    joined = better_targets(df, classes, roles)
    kwh = (F.col("c_avant") - F.col("c_apres")) * F.col(roles.surface)
    return joined.withColumns(
        {
            "gain_m2": F.col("c_avant") - F.col("c_apres"),
            "gain_kwh": kwh,
            "gain_euros": kwh * F.lit(float(price)),
            "gain_co2": kwh * F.lit(float(carbon)),
        }
    ).drop("c_avant", "c_apres")


def reference_savings(
    df: DataFrame,
    classes: DataFrame,
    roles: Roles,
    price: float = REFERENCE_PRICE_PER_KWH,
    cost: float = WORKS_COST,
) -> DataFrame:
    """Savings from the class table: kWh, money, reduction, payback and the yearly totals before and after."""
    joined = better_targets(df, classes, roles)
    before, after, surface = F.col("c_avant"), F.col("c_apres"), F.col(roles.surface)
    kwh = (before - after) * surface
    euros = kwh * F.lit(float(price))
    return joined.withColumns(
        {
            "econ_kwh": kwh,
            "econ_eur": euros,
            "pct": F.bround(safe_ratio(before - after, before) * 100, 0).cast("int"),
            "amortissement": safe_ratio(F.lit(float(cost)), euros),
            "total_avant": (before * surface).cast("bigint"),
            "total_apres": (after * surface).cast("bigint"),
        }
    )


def rounded_payback(df: DataFrame, digits: int = 1) -> DataFrame:
    return df.withColumn("amortissement", half_up(F.col("amortissement"), digits))
