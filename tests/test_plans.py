"""The shape of the plans: what is pushed down, what is shuffled, what is never done."""

import pytest
from pyspark.sql import functions as F

from wattgrade.operators import gains, profile, quality, scenarios, stats
from wattgrade.operators.joins import attach_commune_mean
from wattgrade.plans.catalog import QUERIES
from wattgrade.plans.mapping import ROLES, diagnostics

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries whose plan can be looked at without writing or fitting anything.
PLANNED = [
    name
    for name, q in QUERIES.items()
    if q.run.__module__.rsplit(".", 1)[1] in ("clean_queries", "stats_queries", "profile_queries")
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name].run(spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "BatchEvalPython"):
        assert forbidden not in text


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    rows = diagnostics(spark, SF, "diag_id", "received_at", "intensity", "grade")
    text = plan(quality.latest_per_key(rows, "diag_id", ROLES.survivor_order(rows.columns)))
    before_shuffle = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_only_needed_tables_and_columns_are_read(spark):
    text = plan(stats.group_counts(diagnostics(spark, SF, "grade"), "grade"))
    assert "Join" not in text
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in text


def test_filter_on_a_stored_column_reaches_the_scan(spark, out):
    diagnostics(spark, SF, "diag_id", "intensity", "grade").write.parquet(out)
    text = plan(spark.read.parquet(out).where(quality.in_target_range(ROLES)).select("intensity"))
    assert "GreaterThan(intensity,0.0)" in text and "LessThan(intensity,2000.0)" in text


def test_a_small_summary_is_broadcast_and_a_large_one_is_not(spark):
    records = diagnostics(spark, SF, "diag_id", "commune")
    means = spark.range(5000).select(F.col("id").cast("string").alias("code"), F.rand(1).alias("mean"))
    small = attach_commune_mean(records, "commune", means, "code")
    assert "BroadcastHashJoin" in plan(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        codes = spark.range(1000).select(F.col("id").cast("string").alias("commune"))
        large = attach_commune_mean(codes, "commune", means, "code")
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_commune_is_split_and_keeps_every_row(spark):
    """A third of the records share one commune and the summary is too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    code = F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 5000).cast("string"))
    padding = F.sha1(F.col("id").cast("string")).alias("pad")
    records = spark.range(0, 400_000, 1, 8).select("id", code.alias("code"), padding)
    use = spark.range(4000).select(F.col("id").cast("string").alias("c"), F.col("id").cast("double").alias("mean"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = attach_commune_mean(records, "code", stats.commune_means(use, "c", "mean", "mean"), "c")
        found = joined.collect()
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(found) == 400_000 and len({r["id"] for r in found}) == 400_000
    for r in found:
        number = int(r["code"])
        assert r["mean"] == (float(number) if number < 4000 else None)


def test_scenarios_and_densities_broadcast_only_class_tables(spark):
    rows = diagnostics(spark, SF, "diag_id", "grade", "surface")
    text = plan(scenarios.reference_savings(rows, scenarios.reference_classes(spark), ROLES))
    assert text.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in text
    density = plan(profile.gaussian_density(diagnostics(spark, SF, "grade", "intensity"), "grade", "intensity"))
    assert "SortAggregate" not in density


def test_class_means_are_computed_once_for_all_pairs(spark):
    text = plan(gains.gain_matrix(gains.class_means(diagnostics(spark, SF, "grade", "intensity"), ROLES)))
    assert text.count("FileScan") == 1
