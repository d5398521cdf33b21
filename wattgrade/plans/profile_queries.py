"""Queries on column profiles, densities and renovation scenarios."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wattgrade.functions.scalars import rounded_mean, rounded_sum, safe_ratio
from wattgrade.operators import gains, profile, scenarios, stats
from wattgrade.plans.clean_queries import class_rows
from wattgrade.plans.mapping import CLASSED, DIAG, MEANS, REFERENCE, ROLES, diagnostics, table
from wattgrade.plans.registry import query
from wattgrade.plans.stats_queries import rounded

_PROFILED = ("grade", "building", "received_at", "intensity", "total", "surface")
_LABELS = ("grade", "building", "received_at")
_NUMBERS = ("intensity", "total", "surface")


def _label_sql(column: str) -> str:
    return f"""
    select '{column}' as "column", (select count({column}) from diag) as count,
           (select count(distinct {column}) from diag) as "unique",
           (select {column} from diag where {column} is not null group by {column}
            order by count(*) desc, {column} limit 1) as top,
           (select count(*) from diag where {column} is not null group by {column}
            order by count(*) desc limit 1) as freq,
           cast(null as double) as mean, cast(null as double) as std, cast(null as double) as min,
           cast(null as double) as p25, cast(null as double) as p50, cast(null as double) as p75,
           cast(null as double) as max"""


def _number_sql(column: str) -> str:
    return f"""
    select '{column}' as "column", count({column}) as count, cast(null as bigint) as "unique",
           cast(null as varchar) as top, cast(null as bigint) as freq,
           {rounded(f'avg({column})', 4)} as mean, {rounded(f'stddev_samp({column})', 4)} as std,
           {rounded(f'min({column})', 4)} as min, {rounded(f'quantile_cont({column}, 0.25)', 4)} as p25,
           {rounded(f'quantile_cont({column}, 0.5)', 4)} as p50, {rounded(f'quantile_cont({column}, 0.75)', 4)} as p75,
           {rounded(f'max({column})', 4)} as max
    from diag"""


@query(
    "profile_all",
    f"with {DIAG}" + " union all ".join([_label_sql(c) for c in _LABELS] + [_number_sql(c) for c in _NUMBERS]),
)
def profile_all(spark, sf_dir):
    return profile.profile(diagnostics(spark, sf_dir, *_PROFILED))


@query(
    "null_profile",
    f"with {DIAG} "
    + " union all ".join(f"""select '{c}' as "column", count(*) - count({c}) as nulls from diag""" for c in _PROFILED),
)
def null_profile(spark, sf_dir):
    return profile.null_profile(diagnostics(spark, sf_dir, *_PROFILED))


@query(
    "non_null_counts",
    f"with {DIAG} "
    + " union all ".join(f"""select '{c}' as "column", count({c}) as non_null from diag""" for c in _PROFILED),
)
def non_null_counts(spark, sf_dir):
    return profile.non_null_counts(diagnostics(spark, sf_dir, *_PROFILED))


_TYPES = {"grade": "string", "building": "string", "received_at": "string"}


@query(
    "schema_report",
    f"with {DIAG} "
    + " union all ".join(
        f"""select '{c}' as "column", cast({i} as int) as position, '{_TYPES.get(c, "double")}' as dtype,
                   count({c}) as non_null, count(*) as n_rows from diag"""
        for i, c in enumerate(_PROFILED)
    ),
)
def schema_report(spark, sf_dir):
    return profile.schema_report(diagnostics(spark, sf_dir, *_PROFILED))


@query(
    "corr_matrix",
    f"with {DIAG} "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, {rounded(f'corr({a}, {b})', 6)} as corr from diag"
        for a in _NUMBERS
        for b in _NUMBERS
    ),
)
def corr_matrix(spark, sf_dir):
    return profile.correlation_matrix(diagnostics(spark, sf_dir, *_NUMBERS))


# The 200 derived columns: multiples of intensity and surface on a mean that grows with their number, each but every
# fourth missing on the rows of one line number.
_WIDE = [(k, 1 + k % 7, (k * 3) % 11 - 5, 1 + k % 4) for k in range(200)]


@query(
    "corr_wide",
    f"""with base as (
          select l_linenumber as line, l_extendedprice / l_quantity / 10 as x, l_quantity as y from lineitem),
        centred as (select line, x - (select avg(x) from base) as x, y - (select avg(y) from base) as y from base),
        parts as (
          select line, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as xx, sum(y * y) as yy, sum(x * y) as xy
          from centred group by line),
        cols as (select * from (values {", ".join(f"('c{k}', {a}, {b}, {m})" for k, a, b, m in _WIDE)}) as t(c, a, b, m)),
        gaps as (select distinct p.m as m1, q.m as m2 from cols p, cols q),
        pooled as (
          select m1, m2, sum(n) as n, sum(xx) - sum(sx) * sum(sx) / sum(n) as vx, sum(yy) - sum(sy) * sum(sy) / sum(n) as vy,
                 sum(xy) - sum(sx) * sum(sy) / sum(n) as vxy
          from gaps, parts where (m1 = 4 or line <> m1) and (m2 = 4 or line <> m2) group by m1, m2)
        select p.c as a, q.c as b,
               {rounded('''(p.a * q.a * vx + (p.a * q.b + p.b * q.a) * vxy + p.b * q.b * vy)
                 / (sqrt(p.a * p.a * vx + 2 * p.a * p.b * vxy + p.b * p.b * vy)
                    * sqrt(q.a * q.a * vx + 2 * q.a * q.b * vxy + q.b * q.b * vy))''', 6)} as corr
        from cols p, cols q, pooled where p.m = m1 and q.m = m2""",
)
def corr_wide(spark, sf_dir):
    """Correlations of 200 derived columns, pairwise complete, in one pass."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        (safe_ratio(F.col("l_extendedprice"), F.col("l_quantity")) / F.lit(10.0)).alias("x"),
        F.col("l_quantity").alias("y"),
    )
    wide = [
        F.when(F.lit(m == 4) | (F.col("l_linenumber") != m), F.col("x") * a + F.col("y") * b + 1000.0 * k).alias(f"c{k}")
        for k, a, b, m in _WIDE
    ]
    return profile.correlation_matrix(lines.select(*wide))


_HOLED = {"intensity": "case when surface >= 10 then intensity end", "total": "total", "surface": "surface"}


@query(
    "corr_with_nan",
    f"with {DIAG} "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, {rounded(f'corr({x}, {y})', 6)} as corr from diag"
        for a, x in _HOLED.items()
        for b, y in _HOLED.items()
    ),
)
def corr_with_nan(spark, sf_dir):
    """NaN in one column takes its rows out of that column's pairs only."""
    rows = diagnostics(spark, sf_dir, *_HOLED)
    holed = F.when(F.col("surface") >= 10, F.col("intensity")).otherwise(F.lit(float("nan")))
    return profile.correlation_matrix(rows.withColumn("intensity", holed), list(_HOLED))


@query(
    "kde_by_grade",
    f"""with {CLASSED},
    spread as (select grade as g, count(*) as n, stddev_samp(intensity) * power(count(*), -0.2) as h
               from classed group by grade having count(*) > 10 and stddev_samp(intensity) > 0),
    grid as (select cast(range as double) as x from range(0, 801, 10))
    select grade, x,
           {rounded(f'sum(exp(-0.5 * power((x - intensity) / h, 2))) / (n * h * {math.sqrt(2 * math.pi)!r})', 8)}
             as density
    from classed join spread on grade = g cross join grid
    group by grade, x, n, h""",
)
def kde_by_grade(spark, sf_dir):
    return profile.gaussian_density(class_rows(spark, sf_dir), "grade", "intensity")


_MEASURED_SQL = f"""{MEANS}, targets as (
  select s.grade as source, t.grade as classe_cible, cast(s.conso as double) as c_avant,
         cast(t.conso as double) as c_apres
  from means s join means t on s.grade_ord > t.grade_ord)"""
_REFERENCE_SQL = f"""{CLASSED}, {REFERENCE}, targets as (
  select s.ref_grade as source, t.ref_grade as classe_cible, cast(s.ref_conso as double) as c_avant,
         cast(t.ref_conso as double) as c_apres
  from reference s join reference t on s.ref_grade > t.ref_grade)"""


@query(
    "scenario_savings_v1",
    f"""with {_MEASURED_SQL}
    select diag_id, grade, surface, classe_cible, c_avant - c_apres as gain_m2,
           (c_avant - c_apres) * surface as gain_kwh,
           (c_avant - c_apres) * surface * cast(0.25 as double) as gain_euros,
           (c_avant - c_apres) * surface * cast(0.035 as double) as gain_co2
    from classed join targets on grade = source""",
)
def scenario_savings_v1(spark, sf_dir):
    rows = class_rows(spark, sf_dir)
    means = gains.class_means(rows, ROLES)
    return scenarios.class_savings(rows.select("diag_id", "grade", "surface"), means, ROLES)


def reference_scenarios(spark, sf_dir):
    rows = class_rows(spark, sf_dir).select("diag_id", "grade", "surface")
    return scenarios.reference_savings(rows, scenarios.reference_classes(spark), ROLES)


@query(
    "scenario_savings_v2",
    f"""with {_REFERENCE_SQL}
    select diag_id, grade, classe_cible, (c_avant - c_apres) * surface as econ_kwh,
           (c_avant - c_apres) * surface * cast(0.23 as double) as econ_eur,
           cast(round_even((c_avant - c_apres) / c_avant * 100, 0) as int) as pct
    from classed join targets on grade = source""",
)
def scenario_savings_v2(spark, sf_dir):
    return reference_scenarios(spark, sf_dir).select(
        "diag_id", "grade", "classe_cible", "econ_kwh", "econ_eur", "pct"
    )


@query(
    "scenario_payback",
    f"""with {_REFERENCE_SQL}
    select diag_id, grade, classe_cible,
           cast(15000 as double) / nullif((c_avant - c_apres) * surface * cast(0.23 as double), 0) as amortissement
    from classed join targets on grade = source""",
)
def scenario_payback(spark, sf_dir):
    return reference_scenarios(spark, sf_dir).select("diag_id", "grade", "classe_cible", "amortissement")


@query(
    "scenario_totals",
    f"""with {_REFERENCE_SQL}
    select diag_id, grade, classe_cible, cast(trunc(c_avant * surface) as bigint) as total_avant,
           cast(trunc(c_apres * surface) as bigint) as total_apres
    from classed join targets on grade = source""",
)
def scenario_totals(spark, sf_dir):
    return reference_scenarios(spark, sf_dir).select(
        "diag_id", "grade", "classe_cible", "total_avant", "total_apres"
    )


@query(
    "scenario_summary",
    f"""with {_REFERENCE_SQL}
    select grade, classe_cible, count(*) as nb,
           {rounded('sum((c_avant - c_apres) * surface)', 2)} as econ_kwh,
           {rounded('avg((c_avant - c_apres) * surface * cast(0.23 as double))', 2)} as econ_eur_moy
    from classed join targets on grade = source group by grade, classe_cible""",
)
def scenario_summary(spark, sf_dir):
    rows = reference_scenarios(spark, sf_dir)
    return rows.groupBy("grade", "classe_cible").agg(
        F.count("*").alias("nb"),
        rounded_sum(F.col("econ_kwh"), 2).alias("econ_kwh"),
        rounded_mean(F.col("econ_eur"), 2).alias("econ_eur_moy"),
    )
