"""Queries on shaping, row rules and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrade.functions import scalars as S
from wattgrade.operators import quality, shaping
from wattgrade.operators.features import model_rows
from wattgrade.plans.mapping import (
    CLASS_FIELDS,
    CLASSED,
    COLUMNS,
    DIAG,
    LATEST,
    MODEL,
    ROLES,
    diagnostics,
    from_lines,
    table,
)
from wattgrade.plans.registry import query

ALL = ", ".join(COLUMNS)


def class_rows(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Cleaned diagnostics with the columns the class statistics need and any extra ones."""
    return quality.clean_for_classes(diagnostics(spark, sf_dir, *CLASS_FIELDS, *extra), ROLES)


@query("clean_v1", f"with {CLASSED} select {ALL}, grade_ord from classed")
def clean_v1(spark, sf_dir):
    return quality.clean_for_classes(diagnostics(spark, sf_dir), ROLES)


@query(
    "clean_v2",
    f"""with {MODEL}
    select diag_id, commune, commune_name, grade, building, zone, insulation, energy, surface, intensity from model""",
)
def clean_v2(spark, sf_dir):
    return model_rows(diagnostics(spark, sf_dir), ROLES, carry=("commune_name",))


@query(
    "clean_report",
    f"""with {LATEST}, flags as (
      select grade is not null and intensity is not null and total is not null and surface is not null as complete,
             coalesce(grade in ('A', 'B', 'C', 'D', 'E', 'F', 'G'), false) as graded,
             coalesce(intensity >= 0 and intensity <= 2000 and surface >= 9 and surface <= 1000, false) as ranged
      from latest),
    counts as (
      select (select count(*) from diag) as n, count(*) as keys,
             count(*) filter (where not complete) as incomplete,
             count(*) filter (where complete and not graded) as off_scale,
             count(*) filter (where complete and graded and not ranged) as out_of_range,
             count(*) filter (where complete and graded and ranged) as kept
      from flags)
    select n as rows_before, n - keys as removed_repeated_key, incomplete as removed_incomplete,
           off_scale as removed_off_scale, out_of_range as removed_out_of_range, kept as rows_after,
           n - kept as rows_removed
    from counts""",
)
def clean_report(spark, sf_dir):
    return quality.cleaning_report(diagnostics(spark, sf_dir, *CLASS_FIELDS), ROLES)


# Rows of grade G lose every value, and one column is empty on every row.
_HOLED = ("diag_id", "intensity", "surface", "grade")
_HOLED_SQL = (
    "holed as (select "
    + ", ".join(f"case when grade <> 'G' then {c} end as {c}" for c in _HOLED)
    + ", cast(null as varchar) as empty_column from diag)"
)


def holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = diagnostics(spark, sf_dir, *_HOLED)
    kept = F.col("grade") != "G"
    return rows.select(
        *[F.when(kept, F.col(c)).alias(c) for c in _HOLED], F.lit(None).cast("string").alias("empty_column")
    )


@query(
    "drop_empty_rows",
    f"with {DIAG}, {_HOLED_SQL} select * from holed where diag_id is not null or intensity is not null "
    "or surface is not null or grade is not null or empty_column is not null",
)
def drop_empty_rows(spark, sf_dir):
    return quality.drop_blank_rows(holed(spark, sf_dir))


@query("drop_empty_columns", f"with {DIAG}, {_HOLED_SQL} select diag_id, intensity, surface, grade from holed")
def drop_empty_columns(spark, sf_dir):
    return shaping.drop_empty_columns(holed(spark, sf_dir))


@query(
    "clean_dataset",
    f"with {DIAG}, {_HOLED_SQL} select distinct diag_id, intensity, surface, grade from holed where grade is not null",
)
def clean_dataset(spark, sf_dir):
    return quality.clean_dataset(holed(spark, sf_dir))


@query(
    "dataset_report",
    f"""with {DIAG}, {_HOLED_SQL}
    select count(*) as rows_before, count(*) filter (where grade is null) as removed_blank,
           count(*) filter (where grade is not null)
             - (select count(*) from (select distinct * from holed where grade is not null)) as removed_repeated,
           (select count(*) from (select distinct * from holed where grade is not null)) as rows_after
    from holed""",
)
def dataset_report(spark, sf_dir):
    return quality.dataset_report(holed(spark, sf_dir))


@query("dropna_any", f"with {DIAG} select diag_id, building, surface, grade from diag where building is not null "
       "and surface is not null and grade is not null")
def dropna_any(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "building", "surface", "grade")
    return quality.drop_incomplete_rows(rows, ["building", "surface", "grade"])


_TWICE_SQL = f"{DIAG}, twice as (select {ALL} from diag union all select {ALL} from diag where grade = 'A')"


@query("distinct_rows", f"with {_TWICE_SQL} select distinct {ALL} from twice")
def distinct_rows(spark, sf_dir):
    rows = diagnostics(spark, sf_dir)
    return quality.distinct_rows(rows.union(rows.where(F.col("grade") == "A")))


@query("dedupe_key", f"with {LATEST} select {ALL} from latest")
def dedupe_key(spark, sf_dir):
    rows = diagnostics(spark, sf_dir)
    return quality.latest_per_key(rows, ROLES.key, ROLES.survivor_order(rows.columns))


@query("unwrap_envelope", "select o_orderkey, o_custkey, o_orderpriority from orders")
def unwrap_envelope(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return shaping.unwrap_if_enveloped(orders.select(F.struct("*").alias("data")), max_outer=3)


@query("unwrap_wide_envelope", "select o_orderkey, o_custkey, o_orderstatus from orders")
def unwrap_wide_envelope(spark, sf_dir):
    """Four outer columns: the width rule leaves the frame alone, the presence rule unwraps it."""
    orders = table(spark, sf_dir, "orders")
    record = F.struct("o_orderkey", "o_custkey", "o_orderstatus").alias("data")
    wide = orders.select("o_orderpriority", "o_totalprice", "o_orderdate", record)
    return shaping.unwrap_if_enveloped(shaping.unwrap_if_enveloped(wide, max_outer=3))


@query(
    "wrap_envelope",
    "select 'orders.parquet' as source_file, o_orderkey, o_custkey, o_orderstatus from orders",
)
def wrap_envelope(spark, sf_dir):
    wrapped = shaping.wrap(table(spark, sf_dir, "orders"))
    return wrapped.select("source_file", "data.o_orderkey", "data.o_custkey", "data.o_orderstatus")


# The renames used by the query, one of them of a column that is not there.
_RENAMES = {"c_custkey": "code", "c_name": "nom_commune_ban", "c_missing": "never"}


@query("rename_tolerant", "select c_custkey as code, c_name as nom_commune_ban, c_acctbal from customer")
def rename_tolerant(spark, sf_dir):
    return shaping.rename_present(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), _RENAMES)


@query("project_tolerant", "select c_name, c_custkey from customer")
def project_tolerant(spark, sf_dir):
    return shaping.project_present(table(spark, sf_dir, "customer"), ["c_name", "c_absent", "c_custkey"])


@query("drop_join_column", "select o_orderkey, c_name from orders join customer on o_custkey = c_custkey")
def drop_join_column(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


@query(
    "pad_code",
    """select o_orderkey, case when length(cast(o_custkey as varchar)) < 5 then lpad(cast(o_custkey as varchar), 5, '0') else cast(o_custkey as varchar) end as code,
              case when length(cast(o_custkey as varchar)) < 5 then lpad(cast(o_custkey as varchar), 5, '0') else cast(o_custkey as varchar) end as code_from_double,
              case when length(cast(o_orderkey * 1000 as varchar)) < 5 then lpad(cast(o_orderkey * 1000 as varchar), 5, '0') else cast(o_orderkey * 1000 as varchar) end as longer,
              cast(o_orderkey + 12345678 as varchar) as longer_from_double from orders""",
)
def pad_code(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        S.pad_code(F.col("o_custkey")).alias("code"),
        S.pad_code(F.col("o_custkey").cast("double")).alias("code_from_double"),
        S.pad_code(F.col("o_orderkey") * 1000).alias("longer"),
        S.pad_code((F.col("o_orderkey") + 12345678).cast("double")).alias("longer_from_double"),
    )


@query("normalise_label", "select c_custkey, upper(trim(' ' || lower(c_mktsegment) || ' ')) as label from customer")
def normalise_label(spark, sf_dir):
    messy = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
    return table(spark, sf_dir, "customer").select("c_custkey", S.normalise_label(messy).alias("label"))


@query("fill_unknown", f"with {DIAG} select diag_id, coalesce(building, 'Inconnu') as building from diag")
def fill_unknown(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "building")
    return rows.withColumn("building", S.fill_unknown(F.col("building")))


_TEXT_NUMBER = "case when c_mktsegment = 'BUILDING' then c_name else cast(c_custkey as varchar) end"


@query(
    "cast_numbers",
    f"select c_custkey, try_cast({_TEXT_NUMBER} as double) as code, c_acctbal from customer",
)
def cast_numbers(spark, sf_dir):
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.col("c_custkey").cast("string"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", text.alias("code"), "c_acctbal")
    return shaping.cast_numbers(rows, ["code", "c_acctbal", "absent"])


@query("fill_number", f"select c_custkey, coalesce(try_cast({_TEXT_NUMBER} as double), 0.0) as code from customer")
def fill_number(spark, sf_dir):
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", S.fill_number(text).alias("code"))


@query(
    "grade_ordinal",
    f"""with {DIAG} select diag_id, grade, cast(strpos('ABCDEFG', grade) as int) as grade_ord,
        cast(nullif(strpos('ABCDEFG', insulation), 0) as int) as insulation_ord from diag""",
)
def grade_ordinal(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "grade", "insulation")
    return rows.select(
        "diag_id",
        "grade",
        quality.GRADES.ordinal(F.col("grade")).alias("grade_ord"),
        quality.GRADES.ordinal(F.col("insulation")).alias("insulation_ord"),
    )


@query("audit_columns", "select o_orderkey, 'orders' as _pipeline_source, true as stamped from orders")
def audit_columns(spark, sf_dir):
    stamped = shaping.stamp(table(spark, sf_dir, "orders").select("o_orderkey"), source="orders")
    return stamped.select("o_orderkey", "_pipeline_source", F.col("_silver_timestamp").isNotNull().alias("stamped"))


@query("required_columns", f"with {DIAG} select diag_id, grade, building from diag where grade is not null "
       "and building is not null")
def required_columns(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "grade", "building")
    return rows.where(quality.all_present(["grade", "building"]))


@query("grade_domain", f"with {DIAG} select diag_id, insulation from diag "
       "where insulation in ('A', 'B', 'C', 'D', 'E', 'F', 'G')")
def grade_domain(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "insulation")
    return rows.where(quality.GRADES.contains(F.col("insulation")))


@query("closed_ranges", f"with {DIAG} select diag_id, intensity, surface from diag "
       "where intensity between 0 and 2000 and surface between 9 and 1000")
def closed_ranges(spark, sf_dir):
    return diagnostics(spark, sf_dir, "diag_id", "intensity", "surface").where(quality.in_ranges(ROLES))


@query("open_range", f"with {DIAG} select diag_id, intensity from diag where intensity > 0 and intensity < 2000")
def open_range(spark, sf_dir):
    return diagnostics(spark, sf_dir, "diag_id", "intensity").where(quality.in_target_range(ROLES))


@query("point_lookup", f"with {CLASSED} select grade, count(*) as nb, max(intensity) as max_intensity "
       "from classed where grade = 'E' group by grade")
def point_lookup(spark, sf_dir):
    rows = class_rows(spark, sf_dir).where(F.col("grade") == "E")
    return rows.groupBy("grade").agg(F.count("*").alias("nb"), F.max("intensity").alias("max_intensity"))


@query(
    "safe_ratio",
    "select l_orderkey, l_linenumber, l_discount, l_tax, l_discount / nullif(l_tax, 0) as ratio from lineitem",
)
def safe_ratio(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    ratio = S.safe_ratio(F.col("l_discount"), F.col("l_tax"))
    return lines.select("l_orderkey", "l_linenumber", "l_discount", "l_tax", ratio.alias("ratio"))


@query(
    "json_props",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
)
def json_props(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    props = S.decode_message(F.col("props"), "struct<k: bigint>")
    return events.select("event_id", props["k"].alias("k"))


@query("base_name", "select page_id, regexp_extract(url, '[^/]*$') as name from pages")
def base_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.base_name(F.col("url")).alias("name"))


@query(
    "step_label",
    """select distinct l_returnflag || ' → ' || l_linestatus as saut from lineitem""",
)
def step_label(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(S.step_label(F.col("l_returnflag"), F.col("l_linestatus")).alias("saut")).distinct()


@query(
    "half_up",
    """select l_orderkey, l_linenumber, l_extendedprice,
              cast(round(cast(l_extendedprice as decimal(38, 7)), 1) as double) as price_1,
              cast(round(cast(l_extendedprice / 8 as decimal(38, 8)), 2) as double) as eighth_2
       from lineitem""",
)
def half_up(spark, sf_dir):
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        S.half_up(price, 1).alias("price_1"),
        S.half_up(price / 8, 2).alias("eighth_2"),
    )


# Parts of 10**10 that add to a whole number: a mean lies on a tie, just below or just above it, or well beside it.
_NEAR_TIE = "(l_orderkey % 1000) * 10000000000 + cast(l_linenumber % 5 as bigint) * 1000000000 + 500000000"
_BESIDE = "(l_suppkey % 3 - 1) * (l_partkey % 2)"


@query(
    "half_up_near_ties",
    f"""with parts as (select l_suppkey as supplier, cast({_NEAR_TIE} + {_BESIDE} as hugeint) as part from lineitem),
        sums as (select supplier, sum(part) as total, count(*) as n from parts group by supplier)
        select supplier, n,
               cast((2 * total * 10 + n * 10000000000) // (2 * n * 10000000000) as double) / 10 as mean_1,
               cast((2 * total * 1000 + n * 10000000000) // (2 * n * 10000000000) as double) / 1000 as mean_3,
               -cast((2 * total * 10 + 10000000000) // (2 * 10000000000) as double) / 10 as sum_1
        from sums""",
)
def half_up_near_ties(spark, sf_dir):
    """Means and sums next to a tie, rounded once; the SQL does the same in whole numbers."""
    value = F.expr(f"cast({_NEAR_TIE} + {_BESIDE} as double)") / F.lit(1e10)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supplier"), value.alias("v"))
    return lines.groupBy("supplier").agg(
        F.count("*").alias("n"),
        S.rounded_mean(F.col("v"), 1).alias("mean_1"),
        S.rounded_mean(F.col("v"), 3).alias("mean_3"),
        S.rounded_sum(-F.col("v"), 1).alias("sum_1"),
    )


@query(
    "stateless_clean",
    f"""with {DIAG} select diag_id, received_at, intensity, total, surface, grade, insulation, energy,
               cast(strpos('ABCDEFG', grade) as int) as grade_ord
        from diag where intensity between 0 and 2000 and surface between 9 and 1000""",
)
def stateless_clean(spark, sf_dir):
    rows = from_lines(table(spark, sf_dir, "lineitem")).drop("l_orderkey", "l_partkey")
    return quality.row_rules(rows, ROLES)
