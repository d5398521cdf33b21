"""Star-schema tables in the role of graded assets.

A line item stands for one diagnostic, an order's customer for the commune, the region for the climate zone and the
part type for the building type. Events stand for measured consumption per commune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrade.functions.scalars import pad_code, safe_ratio
from wattgrade.roles import Roles

ROLES = Roles(
    key="diag_id",
    received="received_at",
    grade="grade",
    ordinal="grade_ord",
    intensity="intensity",
    total="total",
    surface="surface",
    commune="commune",
    building="building",
    zone="zone",
    commune_name="commune_name",
    categoricals=("grade", "building", "zone", "insulation", "energy"),
    numerics=("surface",),
)

# Upper limits of the grades, midpoints between neighbouring values of the class table.
GRADE_LIMITS = (("A", 65.0), ("B", 115.0), ("C", 190.0), ("D", 280.0), ("E", 390.0), ("F", 525.0))

LINE_COLUMNS = ("diag_id", "received_at", "intensity", "total", "surface", "grade", "insulation", "energy")
COLUMNS = (
    "diag_id",
    "received_at",
    "intensity",
    "total",
    "surface",
    "grade",
    "commune",
    "commune_name",
    "zone",
    "building",
    "insulation",
    "energy",
)
CLASS_FIELDS = ("diag_id", "received_at", "intensity", "total", "surface", "grade")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_lines(lines: DataFrame) -> DataFrame:
    """The diagnostic columns that a line item carries itself; also runs on a stream of line items."""
    intensity = safe_ratio(F.col("l_extendedprice"), F.col("l_quantity")) / F.lit(10.0)
    lines = lines.withColumn("intensity", intensity)
    branches = F
    for label, limit in GRADE_LIMITS:
        branches = branches.when(F.col("intensity") < limit, label)
    return lines.select(
        "l_orderkey",
        "l_partkey",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "diag_id"
        ),
        F.col("l_shipdate").cast("date").cast("string").alias("received_at"),
        "intensity",
        (F.col("l_extendedprice") / F.lit(10.0)).alias("total"),
        F.col("l_quantity").alias("surface"),
        branches.otherwise("G").alias("grade"),
        F.col("l_returnflag").alias("insulation"),
        F.col("l_linestatus").alias("energy"),
    )


def diagnostics(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """The diagnostics with the wanted columns (all by default).

    Only the tables that supply a wanted column are joined. They are left joins on unique keys, so every line stays
    whichever columns are wanted, also one without an order, customer or part. Join strategies are Spark's choice by table size, with
    adaptive skew splitting for an order or part that holds a large share of the lines.
    """
    wanted = wanted or COLUMNS
    df = from_lines(table(spark, sf_dir, "lineitem"))
    if {"commune", "commune_name", "zone"} & set(wanted):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        df = df.withColumn("commune", pad_code(F.col("o_custkey")))
    if {"commune_name", "zone"} & set(wanted):
        customers = table(spark, sf_dir, "customer").select(
            "c_custkey", F.col("c_name").alias("commune_name"), "c_nationkey"
        )
        df = df.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "zone" in wanted:
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        regions = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("zone"))
        df = df.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        df = df.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    if "building" in wanted:
        building = F.expr("nullif(p_type, 'PROMO')").alias("building")
        parts = table(spark, sf_dir, "part").select("p_partkey", building)
        df = df.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return df.select(*wanted)


def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code_insee_join, conso_reelle_mwh): one row per measurement, the code as a plain number."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("code_insee_join"), F.col("value").alias("conso_reelle_mwh")
    )


DIAG_SQL = """
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as diag_id,
         strftime(l_shipdate, '%Y-%m-%d') as received_at,
         l_extendedprice / l_quantity / 10 as intensity,
         l_extendedprice / 10 as total,
         l_quantity as surface,
         case when l_extendedprice / l_quantity / 10 < 65 then 'A'
              when l_extendedprice / l_quantity / 10 < 115 then 'B'
              when l_extendedprice / l_quantity / 10 < 190 then 'C'
              when l_extendedprice / l_quantity / 10 < 280 then 'D'
              when l_extendedprice / l_quantity / 10 < 390 then 'E'
              when l_extendedprice / l_quantity / 10 < 525 then 'F' else 'G' end as grade,
         case when length(cast(o_custkey as varchar)) < 5 then lpad(cast(o_custkey as varchar), 5, '0') else cast(o_custkey as varchar) end as commune,
         c_name as commune_name,
         r_name as zone,
         nullif(p_type, 'PROMO') as building,
         l_returnflag as insulation,
         l_linestatus as energy
  from lineitem
  left join orders on l_orderkey = o_orderkey
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey
  left join part on l_partkey = p_partkey
"""

_ALL = ", ".join(COLUMNS)
_REST = ", ".join(f"{c} desc nulls last" for c in COLUMNS if c not in CLASS_FIELDS)

# Common table expressions the checking queries start from.
DIAG = f"diag as ({DIAG_SQL})"
LATEST = f"""{DIAG},
latest as (
  select {_ALL} from (
    select {_ALL}, row_number() over (
      partition by diag_id
      order by received_at desc nulls last, intensity desc nulls last, total desc nulls last,
               surface desc nulls last, grade desc nulls last, {_REST}) as rn
    from diag) where rn = 1)"""
CLASSED = f"""{LATEST},
classed as (
  select *, cast(strpos('ABCDEFG', grade) as int) as grade_ord
  from latest
  where grade is not null and intensity is not null and total is not null and surface is not null
    and grade in ('A', 'B', 'C', 'D', 'E', 'F', 'G')
    and intensity >= 0 and intensity <= 2000 and surface >= 9 and surface <= 1000)"""
MEANS = f"""{CLASSED},
means as (
  select grade, grade_ord, round(cast(avg(intensity) as decimal(38, 7)), 1) as conso
  from classed group by grade, grade_ord)"""
COMMUNES = """communes as (
  select case when length(cast(user_id as varchar)) < 5 then lpad(cast(user_id as varchar), 5, '0') else cast(user_id as varchar) end as code, avg(value) as mean
  from events group by 1)"""
MODEL = f"""{DIAG},
{COMMUNES},
model as (
  select diag_id, commune, commune_name, upper(trim(grade)) as grade, coalesce(building, 'Inconnu') as building,
         coalesce(zone, 'Inconnu') as zone, coalesce(insulation, 'Inconnu') as insulation,
         coalesce(energy, 'Inconnu') as energy, coalesce(surface, 0.0) as surface, intensity,
         coalesce(mean, 0.0) as conso_moyenne_commune_mwh
  from diag left join communes on commune = code
  where intensity > 0 and intensity < 2000)"""
IS_TRAIN = "cast('0x' || substr(md5(diag_id), 1, 4) as int) % 10 < 8"
REFERENCE = """reference as (
  select * from (values ('A', 50.0), ('B', 80.0), ('C', 150.0), ('D', 230.0), ('E', 330.0), ('F', 450.0),
                        ('G', 600.0)) as t(ref_grade, ref_conso))"""
STAND_IN = f"""{MODEL},
{REFERENCE},
by_grade as (select grade as g, round(cast(avg(intensity) as decimal(38, 10)), 4) as mean_intensity
             from model where {IS_TRAIN} group by grade),
scored as (
  select m.*, cast(mean_intensity as double) as prediction, cast(ref_conso as double) as prediction_ref
  from model m join by_grade on m.grade = by_grade.g join reference on m.grade = ref_grade
  where not ({IS_TRAIN}))"""
