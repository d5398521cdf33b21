"""Features, regressions, metrics and the choice between models."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tests.helpers import rows
from wattgrade.operators import features, labels, models, sampling
from wattgrade.roles import Roles

ROLES = Roles(
    key="id",
    received="day",
    grade="grade",
    ordinal="ord",
    intensity="x",
    surface="s",
    commune="code",
    categoricals=("grade", "kind"),
    numerics=("s",),
)
SMALL = models.TreeSize(trees=5, depth=4)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 1500
    grade = rng.integers(0, 7, n)
    pdf = pd.DataFrame(
        {
            "id": [f"r{i}" for i in range(n)],
            "grade": [" " + "abcdefg"[g] for g in grade],
            "kind": rng.choice(["house", "flat", None], n),
            "s": rng.uniform(10, 200, n),
            "code": rng.integers(1, 50, n).astype(str),
            "x": 60 * (grade + 1) + rng.normal(0, 10, n),
        }
    )
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="module")
def fitted(data):
    ready = features.model_rows(data, ROLES)
    train, test = sampling.hashed_split(ready, "id")
    return models.train(train, "x", ROLES.categoricals, ROLES.numerics, size=SMALL), train, test


def test_model_rows_fill_and_flag(spark, data):
    schema = "code_insee_join string, conso_moyenne_commune_mwh double"
    means = spark.createDataFrame([("00001", 0.0), ("00002", 5.0)], schema)
    ready = features.model_rows(data, ROLES, means, flag_missing=True)
    assert ready.count() == data.where("x > 0 and x < 2000").count()
    codes = {r[0]: (r[1], r[2]) for r in ready.select(
        "code", "conso_moyenne_commune_mwh", "conso_moyenne_commune_mwh_is_missing").distinct().collect()}
    assert codes["00001"] == (0.0, 0.0) and codes["00002"] == (5.0, 0.0) and codes["00003"] == (0.0, 1.0)
    assert {r[0] for r in ready.select("grade").distinct().collect()} == set("ABCDEFG")
    assert {r[0] for r in ready.select("kind").distinct().collect()} == {"house", "flat", "Inconnu"}


def test_split_is_disjoint_complete_and_independent_of_partitions(data):
    train, test = sampling.hashed_split(data, "id")
    ids, other = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not ids & other and len(ids | other) == 1500 and 0.75 < len(ids) / 1500 < 0.85
    assert ids == {r["id"] for r in sampling.hashed_split(data.repartition(7), "id")[0].collect()}


def test_sample_size_and_stability(data):
    first = rows(sampling.hashed_sample(data, "id", 100).select("id"))
    assert len(first) == 100 and first == rows(sampling.hashed_sample(data.repartition(5), "id", 100).select("id"))
    assert sampling.hashed_sample(data, "id", 9999).count() == 1500


def test_metrics_equal_the_evaluator_and_beat_the_mean(fitted):
    both, train, test = fitted
    mean = train.agg(F.avg("x")).first()[0]
    baseline = test.agg(F.sqrt(F.avg(F.pow(F.col("x") - mean, F.lit(2))))).first()[0]
    for name in (models.FOREST, models.BOOSTED):
        scored = models.score(both.whole(name), test)
        found = {r["metric"]: r["value"] for r in models.metrics_by_model(scored, "x", {name: "prediction"}).collect()}
        for metric in ("rmse", "r2"):
            expected = RegressionEvaluator(labelCol="x", metricName=metric).evaluate(scored)
            assert found[metric.upper()] == pytest.approx(expected, abs=1e-5)
        assert found["RMSE"] < baseline


def test_importances_sum_to_one_and_rank_the_grade_first(fitted):
    both, _, test = fitted
    for name in (models.FOREST, models.BOOSTED):
        ranked = models.feature_importance(both, name, both.preparation.transform(test))
        assert [r[0] for r in ranked] == [1, 2, 3] and ranked[0][1] == "grade"
        assert {r[1] for r in ranked} == {"grade", "kind", "s"}
        assert sum(r[2] for r in ranked) == pytest.approx(1)


def test_one_hot_importances_are_added_per_variable(data):
    ready = features.model_rows(data, ROLES)
    both = models.train(ready, "x", ROLES.categoricals, ROLES.numerics, [models.FOREST], SMALL, one_hot=True)
    ranked = models.feature_importance(both, models.FOREST, both.preparation.transform(ready))
    assert {r[1] for r in ranked} == {"grade", "kind", "s"} and sum(r[2] for r in ranked) == pytest.approx(1)


def test_saved_model_scores_the_same(fitted, out):
    both, _, test = fitted
    models.save_model(both.whole(models.BOOSTED), out)
    again = models.score(models.load_model(out), test).select("id", "prediction")
    assert rows(again) == rows(models.score(both.whole(models.BOOSTED), test).select("id", "prediction"))


@pytest.mark.parametrize(
    "forest, boosted, expected", [(5.0, 5.0, "RandomForest"), (5.0, 4.9, "GBT"), (4.9, 5.0, "RandomForest")]
)
def test_choice(spark, forest, boosted, expected):
    metrics = models.metrics_rows(
        spark,
        [("RandomForest", "RMSE", forest), ("RandomForest", "R2", 0.5), ("GBT", "RMSE", boosted), ("GBT", "R2", 0.6)],
    )
    found = models.best_model(metrics).first()
    assert found["best_model"] == expected and found["rmse"] == min(forest, boosted)


def test_many_labels_train_as_numbers(spark):
    df = spark.range(400).select(
        (F.col("id") % 40).cast("string").alias("label"),
        F.col("id").cast("string").alias("unique"),
        (F.col("id") % 40).cast("double").alias("x"),
    )
    small = models.TreeSize(trees=2, depth=2, partitions=3)
    both = models.train(df, "x", ["label"], [], size=small)
    assert both.models[models.FOREST].getOrDefault("maxBins") == 41 and not both.ranked
    both = models.train(df, "x", ["label", "unique"], [], size=small, max_categories=100)
    assert both.ranked == ["unique"] and both.models[models.FOREST].getOrDefault("maxBins") == 41
    unseen = df.limit(1).withColumn("unique", F.lit("none"))
    assert both.ready(unseen).first()["unique_rank"] == 400.0
    assert models.score(both.whole(models.BOOSTED), both.ready(df)).where("prediction is not null").count() == 400
    assert {r[1] for r in models.feature_importance(both, models.FOREST, both.prepared(df))} == {"label", "unique_rank"}


def test_label_order_and_unseen_labels(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("c", None), (None, 2)], "g string, `h i` int")
    table = labels.label_table(df, ["g", "h i"])
    assert rows(table) == [("g", "a", 1, 1), ("g", "b", 1, 2), ("g", "c", 2, 0), ("h i", "1", 2, 0), ("h i", "2", 2, 1)]
    model = features.indexer(["g"]).fit(df)
    assert list(model.labelsArray[0]) == ["c", "a", "b"]
    unseen = spark.createDataFrame([("z",), (None,), ("b",)], "g string")
    assert [r["g_idx"] for r in model.transform(unseen).collect()] == [3.0, 3.0, 2.0]
    ranked = labels.with_label_ranks(unseen, table, ["g"])
    assert sorted(r["g_rank"] for r in ranked.collect()) == [2.0, 3.0, 3.0]
    assert labels.label_table(df.limit(0), ["g"]).count() == 0


def test_labels_are_numbered_across_tasks(spark):
    df = spark.range(20000).select(F.concat(F.lit("l"), (F.col("id") % 7000).cast("string")).alias("g"))
    found = {r["label"]: r["idx"] for r in labels.label_table(df.repartition(9), ["g"]).collect()}
    counts = df.toPandas()["g"].value_counts()
    assert found == {g: i for i, g in enumerate(sorted(counts.index, key=lambda g: (-counts[g], g)))}


FIT = """
import sys, tempfile
from wattgrade.session import build_session
from wattgrade.operators import models
from pyspark.sql import functions as F
spark = build_session("fit", **{"spark.master": sys.argv[1], "spark.sql.shuffle.partitions": sys.argv[2],
    "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")})
noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 50
rows = spark.range(3000).select("id", (F.col("id") % 9).cast("string").alias("g"), (F.col("id") % 50 * 1.5).alias("s"))
rows = rows.withColumn("x", F.col("s") * 2 + F.col("g").cast("double") * 10 + noise).repartition(int(sys.argv[2]))
size = models.TreeSize(trees=4, depth=4, partitions=5)
both = models.train(rows, "x", ["g"], ["s"], size=size, keys=["id"], max_rows=2000)
print("TREES", hash("".join(both.models[k].toDebugString.split(chr(10), 1)[1] for k in sorted(both.models))))
"""


def test_the_same_trees_on_any_number_of_cores():
    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"PYTHONPATH": root, "PYTHONHASHSEED": "0"}
    found = set()
    for master, parts in (("local[2]", "3"), ("local[4]", "8"), ("local[8]", "11")):
        out = subprocess.run([sys.executable, "-c", FIT, master, parts], env=env, capture_output=True, text=True, timeout=300)
        found.add(next(line for line in out.stdout.splitlines() if line.startswith("TREES")))
    assert len(found) == 1


def test_boosting_on_cells_makes_the_trees_of_the_rows(spark):
    from wattgrade.operators import cells

    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 10
    df = spark.range(4000).select("id", (F.col("id") % 3).cast("string").alias("g"), (F.floor(F.col("id") / 7) % 20).alias("s"))
    df = df.withColumn("x", F.col("s") * 3 + F.col("g").cast("double") * 10 + noise)
    found = cells.cells_of(df, "x", ["g"], ["s"], 32)
    assert found.count() == 60 and found.agg(F.sum(cells.ROWS)).first()[0] == 4000
    size = models.TreeSize(trees=4, depth=4, partitions=3)
    boosted = models.train(df, "x", ["g"], ["s"], [models.BOOSTED], size, keys=["id"])
    plain = models.GBTRegressor(featuresCol="features", labelCol="x", maxIter=4, maxDepth=4, seed=42)
    rowwise = plain.fit(boosted.prepared(df))
    both = rowwise.setPredictionCol("p").transform(models.score(boosted.models[models.BOOSTED], boosted.prepared(df)))
    assert both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-6).count() == 0


def test_bins_and_cells_of_odd_columns(spark):
    from wattgrade.operators import cells

    odd = F.when(F.col("id") % 2 == 0, 0.0).when(F.col("id") == 1, float("nan")).when(F.col("id") == 3, float("inf"))
    df = spark.range(2000).select(F.when(F.col("id") != 5, odd.otherwise(F.col("id") - 1000.0)).alias("a b"), F.lit(1.0).alias("x"))
    values = cells.bin_values(df, "a b", 10)
    assert 0.0 in values and 9 <= len(values) <= 11 and values == sorted(values) and max(values) > 800 and min(values) < -800
    found = cells.cells_of(df, "x", [], ["a b"], 12)
    assert found.agg(F.sum(cells.ROWS)).first()[0] == 2000 and found.where("`a b` is null").first()[cells.ROWS] == 1
    near = df.select(cells.snapped(F.col("a b"), values).alias("v"), "a b").where("`a b` between -999 and 999")
    edges = [(a + b) / 2 for a, b in zip(values, values[1:])]
    assert all(sum(r["v"] > e for e in edges) == sum(r["a b"] > e for e in edges) for r in near.collect())
    assert cells.bin_values(df.limit(0), "a b", 10) == []


def test_large_tables_get_more_partitions():
    assert [models.partitions_for(n, 16) for n in (0, 8_000_000, 8_000_001, 30_000_000)] == [16, 16, 17, 60]


def test_forest_of_a_large_table_learns_from_parts_of_cells(spark, monkeypatch):
    from wattgrade.operators import cells

    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 10
    df = spark.range(20000).select("id", (F.col("id") % 3).cast("string").alias("g"), (F.floor(F.col("id") / 7) % 20).alias("s"))
    df = df.withColumn("x", F.col("s") * 3 + F.col("g").cast("double") * 10 + noise)
    parts = cells.cells_of(df, "x", ["g"], ["s"], 32, 4, ["id"])
    assert parts.count() == 240 and parts.agg(F.sum(cells.ROWS)).first()[0] == 20000
    again = cells.cells_of(df.repartition(7), "x", ["g"], ["s"], 32, 4, ["id"])
    assert rows(parts) == rows(again)
    seen = []
    kept = models.laid_out
    monkeypatch.setattr(models, "laid_out", lambda learned, *rest: seen.append(learned.count()) or kept(learned, *rest))
    size = models.TreeSize(trees=10, depth=4, partitions=3)
    single = models.train(df, "x", ["g"], ["s"], [models.FOREST], size, keys=["id"])
    monkeypatch.setattr(models, "SINGLE_ROWS", 1000)
    dealt = models.train(df, "x", ["g"], ["s"], [models.FOREST], size, keys=["id"])
    assert seen[0] == 20000 and seen[1] <= 60 * models.CELL_DRAWS
    error = {}
    for name, both in (("single", single), ("dealt", dealt)):
        scored = models.score(both.whole(models.FOREST), df)
        found = models.metrics_by_model(scored, "x", {name: "prediction"}).collect()
        error[name] = found[0]["value"]
    assert error["dealt"] < 1.05 * error["single"]


def test_forest_draws_single_rows_at_any_size(spark, monkeypatch):
    n = 1_000_001  # a million was the size beyond which cells were drawn
    df = spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 20).alias("s"))
    df = df.withColumn("x", F.col("s") * 3.0 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 10)
    seen = []
    kept = models.laid_out
    monkeypatch.setattr(models, "laid_out", lambda learned, *rest: seen.append(learned.count()) or kept(learned, *rest))
    size = models.TreeSize(trees=1, depth=1, partitions=8)
    forest = models.train(df, "x", ["g"], ["s"], [models.FOREST], size, keys=["id"]).models[models.FOREST]
    assert seen == [n] and forest.getNumTrees == 1
