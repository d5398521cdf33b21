"""Queries on statistics, gains, joins and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattgrade.operators import gains, sampling, stats
from wattgrade.operators.features import COMMUNE_MEAN, model_rows
from wattgrade.operators.joins import attach_commune_mean
from wattgrade.functions.scalars import half_up, pad_code
from wattgrade.plans.clean_queries import class_rows
from wattgrade.plans.mapping import (
    CLASSED,
    COMMUNES,
    DIAG,
    LATEST,
    MEANS,
    MODEL,
    REFERENCE,
    ROLES,
    CLASS_FIELDS,
    consumption,
    diagnostics,
    table,
)
from wattgrade.operators.quality import latest_per_key
from wattgrade.operators.scenarios import reference_classes
from wattgrade.plans.registry import query
from wattgrade.sources.readers import concat_by_name


def rounded(expression: str, digits: int) -> str:
    """The SQL form of half-up rounding."""
    return f"cast(round(cast({expression} as decimal(38, {digits + 6})), {digits}) as double)"


_STATS_SQL = f"""{CLASSED}, stats as (
  select grade, grade_ord, count(*) as nb_logements, {rounded('avg(intensity)', 1)} as conso_moy_m2,
         {rounded('avg(total)', 0)} as conso_moy_totale, {rounded('avg(surface)', 1)} as surface_moy,
         {rounded('stddev_samp(intensity)', 1)} as conso_std
  from classed group by grade, grade_ord)"""


@query("class_stats", f"with {_STATS_SQL} select * from stats")
def class_stats(spark, sf_dir):
    return stats.class_stats(class_rows(spark, sf_dir), ROLES)


@query("class_means", f"with {MEANS} select grade, grade_ord as ord, cast(conso as double) as conso from means")
def class_means(spark, sf_dir):
    means = gains.class_means(class_rows(spark, sf_dir), ROLES)
    return means.withColumn("conso", F.col("conso").cast("double"))


@query(
    "grade_distribution",
    f"""with {CLASSED} select grade, count(*) as nb, {rounded('avg(intensity)', 1)} as "conso_moy_kWh_m2"
        from classed group by grade""",
)
def grade_distribution(spark, sf_dir):
    return stats.grade_distribution(class_rows(spark, sf_dir), ROLES)


@query(
    "mean_by_building",
    f"with {CLASSED} select building, {rounded('avg(intensity)', 1)} as conso_moy from classed group by building",
)
def mean_by_building(spark, sf_dir):
    rows = class_rows(spark, sf_dir, "building")
    return stats.mean_by(rows, "building", "intensity", "conso_moy", descending=True, keep_null_group=True)


@query(
    "mean_by_zone",
    f"with {DIAG} select zone, {rounded('avg(intensity)', 4)} as conso from diag where zone is not null group by zone",
)
def mean_by_zone(spark, sf_dir):
    return stats.mean_by(diagnostics(spark, sf_dir, "zone", "intensity"), "zone", "intensity", "conso", digits=4)


@query("commune_mean", f"with {COMMUNES} select code, {rounded('mean', 4)} as mean from communes")
def commune_mean(spark, sf_dir):
    means = stats.commune_means(consumption(spark, sf_dir), "code_insee_join", "conso_reelle_mwh", "mean")
    return means.select(F.col("code_insee_join").alias("code"), half_up(F.col("mean"), 4).alias("mean"))


@query(
    "commune_long_codes",
    """select cast(o_custkey + 100000 as varchar) as code, count(*) as n, min(o_totalprice) as low,
              max(o_totalprice) as high from orders group by 1""",
)
def commune_long_codes(spark, sf_dir):
    """Codes longer than five digits stay apart."""
    orders = table(spark, sf_dir, "orders").withColumn("code", pad_code((F.col("o_custkey") + 100000).cast("double")))
    low, high = F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high")
    return orders.groupBy("code").agg(F.count("*").alias("n"), low, high)


@query("commune_count", f"with {COMMUNES} select count(*) as communes from communes")
def commune_count(spark, sf_dir):
    means = stats.commune_means(consumption(spark, sf_dir), "code_insee_join", "conso_reelle_mwh", "mean")
    return stats.group_total(means, "code_insee_join", "communes")


@query(
    "commune_left_join",
    f"with {DIAG}, {COMMUNES} select diag_id, commune, intensity, {rounded('mean', 4)} as mean "
    "from diag left join communes on commune = code",
)
def commune_left_join(spark, sf_dir):
    means = stats.commune_means(consumption(spark, sf_dir), "code_insee_join", "conso_reelle_mwh", "mean")
    means = means.withColumn("mean", half_up(F.col("mean"), 4))
    rows = diagnostics(spark, sf_dir, "diag_id", "commune", "intensity")
    return attach_commune_mean(rows, "commune", means, "code_insee_join")


@query(
    "model_rows",
    f"""with {MODEL}
    select diag_id, commune, commune_name, grade, building, zone, insulation, energy, surface, intensity,
           {rounded(COMMUNE_MEAN, 4)} as {COMMUNE_MEAN}
    from model""",
)
def training_rows(spark, sf_dir):
    means = stats.commune_means(consumption(spark, sf_dir), "code_insee_join", "conso_reelle_mwh", COMMUNE_MEAN)
    rows = model_rows(diagnostics(spark, sf_dir), ROLES, means, carry=("commune_name",))
    return rows.withColumn(COMMUNE_MEAN, half_up(F.col(COMMUNE_MEAN), 4))


@query(
    "missing_indicator",
    f"""with {DIAG}, {COMMUNES} select diag_id, commune, {rounded('coalesce(mean, 0.0)', 4)} as {COMMUNE_MEAN},
        cast(case when mean is null then 1 else 0 end as double) as {COMMUNE_MEAN}_is_missing
        from diag left join communes on commune = code where intensity > 0 and intensity < 2000""",
)
def missing_indicator(spark, sf_dir):
    """The filled commune mean beside a flag that tells a filled zero from a measured one."""
    means = stats.commune_means(consumption(spark, sf_dir), "code_insee_join", "conso_reelle_mwh", COMMUNE_MEAN)
    rows = diagnostics(spark, sf_dir, "diag_id", "commune", "intensity")
    flagged = model_rows(rows, ROLES, means, flag_missing=True)
    mean = half_up(F.col(COMMUNE_MEAN), 4).alias(COMMUNE_MEAN)
    return flagged.select("diag_id", "commune", mean, f"{COMMUNE_MEAN}_is_missing")


@query(
    "value_counts",
    f"with {DIAG} select building, count(*) as count from diag where building is not null group by building",
)
def value_counts(spark, sf_dir):
    return stats.group_counts(diagnostics(spark, sf_dir, "building"), "building")


@query("large_groups", f"with {DIAG} select commune, count(*) as nb from diag group by commune having count(*) > 10")
def large_groups(spark, sf_dir):
    return stats.groups_larger_than(diagnostics(spark, sf_dir, "commune"), "commune", 10)


@query(
    "top10_communes",
    f"""with {DIAG}, m as (select commune_name, {rounded('avg(intensity)', 4)} as conso from diag
        where commune_name is not null group by commune_name)
        select commune_name, conso from m order by conso desc, commune_name limit 10""",
)
def top10_communes(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "commune_name", "intensity")
    return stats.top_groups(rows, "commune_name", "intensity", "conso")


@query(
    "kpi_classes",
    f"""with {_STATS_SQL}, k as (
        select cast(sum(nb_logements) as bigint) as total_logements,
               coalesce(max(case when grade = 'G' then conso_moy_m2 end), 0.0) as conso_moy_pire,
               coalesce(max(case when grade = 'A' then conso_moy_m2 end), 0.0) as conso_moy_meilleure
        from stats)
        select *, case when conso_moy_meilleure <> 0
                       then {rounded('conso_moy_pire - conso_moy_meilleure', 0)} else 0.0 end as gain_total
        from k""",
)
def kpi_classes(spark, sf_dir):
    return stats.class_kpis(stats.class_stats(class_rows(spark, sf_dir), ROLES), ROLES)


_PAIRS_SQL = f"""{MEANS}, pairs as (
  select s.grade as classe_origine, t.grade as classe_cible, s.grade_ord as ord_origine, t.grade_ord as ord_cible,
         s.conso as conso_origine, t.conso as conso_cible
  from means s join means t on s.grade_ord > t.grade_ord)"""


@query(
    "gain_matrix",
    f"""with {_PAIRS_SQL} select classe_origine, classe_cible,
        cast(round(conso_cible - conso_origine, 0) as double) as "gain_kWh_m2" from pairs""",
)
def gain_matrix(spark, sf_dir):
    return gains.gain_matrix(gains.class_means(class_rows(spark, sf_dir), ROLES))


_LADDER_SQL = f"""{_PAIRS_SQL}, ladder as (
  select classe_origine || ' → ' || classe_cible as saut, classe_origine, classe_cible,
         cast(conso_origine - conso_cible as double) as "gain_kWh_m2",
         {rounded('cast(conso_origine - conso_cible as double) / nullif(cast(conso_origine as double), 0) * 100', 1)}
           as gain_pct
  from pairs where ord_origine = ord_cible + 1)"""


@query("gain_ladder", f"with {_LADDER_SQL} select * from ladder")
def gain_ladder(spark, sf_dir):
    return gains.gain_ladder(gains.class_means(class_rows(spark, sf_dir), ROLES))


@query("ranked_ladder", f'with {_LADDER_SQL} select * from ladder order by "gain_kWh_m2" desc, saut')
def ranked_ladder(spark, sf_dir):
    return gains.ranked_ladder(gains.class_means(class_rows(spark, sf_dir), ROLES))


@query(
    "lookup_step",
    f"""with {_PAIRS_SQL} select classe_origine, classe_cible, cast(conso_origine as double) as conso_avant,
        cast(conso_cible as double) as conso_apres,
        cast(conso_origine as double) - cast(conso_cible as double) as gain_m2
        from pairs where classe_origine = 'E' and classe_cible = 'B'""",
)
def lookup_step(spark, sf_dir):
    return gains.lookup_step(gains.class_means(class_rows(spark, sf_dir), ROLES), "E", "B")


@query(
    "reference_gap",
    f"""with {MEANS}, {REFERENCE}
    select ref_grade as grade, cast(ref_conso as double) as conso_reference, cast(conso as double) as conso_mesuree,
           cast(conso as double) - cast(ref_conso as double) as ecart
    from reference left join means on grade = ref_grade""",
)
def reference_gap(spark, sf_dir):
    """Literal class table beside the measured means."""
    measured = gains.class_means(class_rows(spark, sf_dir), ROLES)
    measured = measured.select("grade", F.col("conso").cast("double").alias("conso_mesuree"))
    published = reference_classes(spark).select("grade", F.col("conso").cast("double").alias("conso_reference"))
    gap = F.col("conso_mesuree") - F.col("conso_reference")
    return published.join(measured, "grade", "left").withColumn("ecart", gap)


@query("peek_rows", f"with {LATEST} select diag_id, grade, intensity from latest order by diag_id limit 20")
def peek_rows(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, *CLASS_FIELDS)
    latest = latest_per_key(rows, ROLES.key, ROLES.survivor_order(rows.columns))
    return sampling.first_rows(latest, ["diag_id"], 20).select("diag_id", "grade", "intensity")


@query(
    "sample_800",
    f"with {LATEST} select diag_id, intensity, surface from latest order by md5(diag_id), diag_id limit 800",
)
def sample_800(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, *CLASS_FIELDS)
    latest = latest_per_key(rows, ROLES.key, ROLES.survivor_order(rows.columns))
    return sampling.hashed_sample(latest.select("diag_id", "intensity", "surface"), "diag_id", 800)


@query(
    "hash_split",
    f"""with {DIAG} select cast('0x' || substr(md5(diag_id), 1, 4) as int) % 10 < 8 as is_train, grade,
        count(*) as nb, count(distinct diag_id) as keys from diag group by 1, 2""",
)
def hash_split(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "grade")
    per_key = rows.groupBy("grade", "diag_id").agg(F.count("*").alias("copies"))
    sides = per_key.withColumn("is_train", sampling.in_training("diag_id"))
    return sides.groupBy("is_train", "grade").agg(F.sum("copies").alias("nb"), F.count("*").alias("keys"))


@query("source_cap", "select * from customer order by c_custkey limit 1000")
def source_cap(spark, sf_dir):
    return sampling.first_rows(table(spark, sf_dir, "customer"), ["c_custkey"], 1000)


@query(
    "concat_frames",
    """select c_custkey as code, c_name as name, c_acctbal as balance, cast(null as varchar) as segment from customer
       union all select s_suppkey, s_name, s_acctbal, cast(null as varchar) from supplier
       union all select c_custkey, c_name, null, c_mktsegment from customer""",
)
def concat_frames(spark, sf_dir):
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key = F.col("c_custkey").alias("code")
    return concat_by_name(
        [
            customers.select(key, F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
            suppliers.select(
                F.col("s_acctbal").alias("balance"),
                F.col("s_name").alias("name"),
                F.col("s_suppkey").alias("code"),
            ),
            customers.select(F.col("c_mktsegment").alias("segment"), key, F.col("c_name").alias("name")),
        ]
    )
