"""Profiles, exact quantiles, correlations and densities against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from wattgrade.operators import profile, ranking


def frame(spark, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(100, 30, n))
    pdf = pd.DataFrame(
        {
            "grade": rng.choice(list("ABCDE"), n, p=[0.4, 0.3, 0.2, 0.099, 0.001]),
            "hot": hot,
            "u": rng.random(n) * 1000,
            "k": rng.integers(0, 5, n),
        }
    )
    pdf.loc[::7, "u"] = np.nan
    cells = pdf.astype(object).where(pdf.notna(), None)
    df = spark.createDataFrame(cells, "grade string, hot double, u double, k bigint")
    return pdf, df.repartition(5)


@pytest.mark.parametrize("probabilities", [(0.25, 0.5, 0.75), (0.0, 0.013, 0.999, 1.0)])
def test_exact_quantiles_match_brute_force_with_a_hot_value(spark, probabilities):
    pdf, df = frame(spark)
    found = {r["column"]: r for r in ranking.exact_quantiles(df, ["hot", "u", "k"], probabilities).collect()}
    for c in ("hot", "u", "k"):
        expected = pdf[c].astype(float).dropna().quantile(list(probabilities)).tolist()
        assert [found[c][f"q{i}"] for i in range(len(probabilities))] == pytest.approx(expected, rel=1e-12)


@pytest.mark.parametrize("probabilities", [(0.25, 0.5, 0.75), (0.0, 0.37, 0.38, 1.0)])
def test_brackets_shrink_the_work_but_not_the_result(spark, probabilities, monkeypatch):
    pdf, df = frame(spark, 30000)
    columns = ["hot", "u", "k"]
    monkeypatch.setattr(ranking, "rank_error", lambda size=0: 0.01)
    brackets = ranking.brackets_from_sketches(df, columns, probabilities)
    counts = ranking.value_counts(df, columns, brackets)
    assert counts.agg(F.sum("n")).first()[0] == pdf[columns].count().sum()
    assert counts.count() < ranking.value_counts(df, columns, {}).count() / 2
    found = {r["column"]: r for r in ranking.exact_quantiles(df, columns, probabilities).collect()}
    for c in columns:
        expected = pdf[c].astype(float).quantile(list(probabilities)).tolist()
        assert [found[c][f"q{i}"] for i in range(len(probabilities))] == pytest.approx(expected, rel=1e-12)


def test_a_missed_bracket_is_noticed_and_repaired(spark, monkeypatch):
    pdf, df = frame(spark, 5000)
    wrong = {"u": [(990.0, 991.0)]}
    counts = ranking.value_counts(df, ["u"], wrong)
    assert ranking.quantiles_of_counts(counts, (0.5,)).first()["missed"]
    monkeypatch.setattr(ranking, "brackets_from_sketches", lambda *_: wrong)
    found = ranking.exact_quantiles(df, ["u"], (0.5,)).first()
    assert found["q0"] == pytest.approx(pdf["u"].median(), rel=1e-12)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "a double")
    found = profile.profile(df).first()
    assert (found["count"], found["mean"], found["p50"], found["max"]) == (2, 2.0, 2.0, 3.0)


def test_exact_quantiles_of_small_and_empty_columns(spark):
    df = spark.createDataFrame([(3.0, None), (1.0, None)], "a double, e double")
    found = {r["column"]: r["q0"] for r in ranking.exact_quantiles(df, ["a", "e"], (0.5,)).collect()}
    assert found == {"a": 2.0}


def test_approximate_quantiles_are_close(spark):
    pdf, df = frame(spark)
    found = {r["column"]: r for r in ranking.approx_quantiles(df, ["u"], (0.5,)).collect()}
    assert found["u"]["q0"] == pytest.approx(pdf["u"].median(), rel=0.01)


def test_profile_matches_pandas_describe(spark):
    pdf, df = frame(spark)
    df = df.withColumn("nothing", F.lit(None).cast("string"))
    found = {r["column"]: r for r in profile.profile(df, digits=6).collect()}
    expected = pdf.describe(include="all").T
    for c in ("hot", "u", "k"):
        assert found[c]["count"] == expected.loc[c, "count"]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")):
            assert found[c][ours] == pytest.approx(expected.loc[c, theirs], abs=1e-6)
    assert (found["grade"]["unique"], found["grade"]["top"]) == (5, "A")
    assert found["grade"]["freq"] == (pdf["grade"] == "A").sum()
    assert found["nothing"]["count"] == 0 and found["nothing"]["top"] is None


def test_null_and_schema_reports(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(profile.null_profile(df), "kept") == [("b", 2), ("a", 1)]
    assert rows(profile.non_null_counts(df)) == [("a", 1), ("b", 0)]
    assert rows(profile.schema_report(df)) == [("a", 0, "int", 1, 2), ("b", 1, "string", 0, 2)]
    assert rows(profile.schema_report(df.limit(0))) == [("a", 0, "int", 0, 0), ("b", 1, "string", 0, 0)]


def test_correlation_is_pairwise_complete(spark):
    pdf, df = frame(spark)
    expected = pdf[["hot", "u", "k"]].corr()
    for r in profile.correlation_matrix(df).collect():
        assert r["corr"] == pytest.approx(expected.loc[r["a"], r["b"]], abs=1e-6)


def test_profile_takes_two_passes_at_any_size(spark):
    """Rows of the source are counted as they are read, with a small and with a larger table."""
    for n in (50, 20000):
        read = spark.sparkContext.accumulator(0)
        _, df = frame(spark, n)

        def counted(batches, read=read):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        profile.profile(df.mapInArrow(counted, df.schema)).collect()
        assert read.value == 2 * n


def test_profile_of_empty_tables(spark):
    df = spark.createDataFrame([], "a double, b string")
    found = {r["column"]: r for r in profile.profile(df).collect()}
    assert found["a"]["count"] == found["b"]["count"] == 0 and found["a"]["p50"] is None and found["b"]["top"] is None
    one = profile.profile(spark.createDataFrame([(float("inf"),), (1.0,), (None,)], "a double")).first()
    assert one["count"] == 2 and one["max"] == float("inf") and one["p25"] == float("inf")


def test_co_moments_of_many_columns_with_large_means(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(3000, 3))
    columns = [f"c {k}" for k in range(75)]
    pdf = pd.DataFrame(base @ rng.normal(size=(3, 75)) + rng.normal(size=(3000, 75)), columns=columns)
    pdf = (pdf + 1e9).astype(float)
    for k in range(0, 75, 4):
        pdf.iloc[k::7, k] = np.nan
    pdf.iloc[:, 10] = np.nan
    pdf.iloc[:, 11] = 5e9
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"`{c}` double" for c in columns))
    found = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df.repartition(7), digits=6).collect()}
    expected = (pdf - 1e9).corr()
    assert len(found) == 75 * 75
    for a in columns:
        for b in columns:
            if "c 10" in (a, b) or "c 11" in (a, b):
                assert found[a, b] is None
            else:
                assert found[a, b] == pytest.approx(expected.loc[a, b], abs=2e-6)


def test_density_matches_brute_force_and_integrates_to_one(spark):
    pdf, df = frame(spark, 3000)
    grid = [float(x) for x in range(-200, 401, 5)]  # more points than one pass takes
    found = profile.gaussian_density(df, "grade", "hot", grid=grid, digits=12).toPandas()
    assert set(found["grade"]) == {g for g, n in pdf["grade"].value_counts().items() if n > 10}
    for grade, part in found.groupby("grade"):
        values = pdf.loc[pdf["grade"] == grade, "hot"].to_numpy()
        h = values.std(ddof=1) * len(values) ** -0.2
        part = part.sort_values("x")
        expected = [np.exp(-0.5 * ((x - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi)) for x in grid]
        assert part["density"].to_numpy() == pytest.approx(np.array(expected), abs=1e-9)
        assert part["density"].sum() * 5 == pytest.approx(1, abs=0.01)


def test_each_block_of_columns_is_prepared_once(monkeypatch):
    import numpy as np

    from wattgrade.operators import comoments

    calls = []
    middle = comoments.middle
    monkeypatch.setattr(comoments, "middle", lambda *a: calls.append(1) or middle(*a))
    x = np.array([[1.0, 2.0, np.nan], [3.0, np.nan, 4.0], [5.0, 7.0, 6.0]])
    blocks = [comoments.deviations(x[:, [i]]) for i in range(3)]
    figures = {(i, j): comoments.moments_of(blocks[i], blocks[j])[:, 0, 0] for i in range(3) for j in range(i, 3)}
    assert len(calls) == 3
    assert figures[0, 1].tolist() == [2.0, 3.0, 4.5, 8.0, 12.5, 10.0] and figures[1, 2].tolist() == [1.0, 7.0, 6.0, 0.0, 0.0, 0.0]
