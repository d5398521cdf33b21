"""Class means, gain matrix, ladder and scenarios."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import rows
from wattgrade.operators import gains, scenarios, stats
from wattgrade.roles import GRADES, Roles

ROLES = Roles(key="id", received="day", grade="grade", ordinal="ord", intensity="x", surface="s", total="t")


def classes(spark, pairs):
    data = [(g, GRADES.labels.index(g) + 1, float(v)) for g, v in pairs]
    df = spark.createDataFrame(data, "grade string, ord int, conso double")
    return df.withColumn("conso", F.col("conso").cast(gains.MEAN_TYPE))


def test_missing_classes_give_no_pairs(spark):
    means = classes(spark, [("A", 50), ("C", 150), ("G", 600)])
    assert rows(gains.gain_matrix(means)) == [("C", "A", -100.0), ("G", "A", -550.0), ("G", "C", -450.0)]
    assert gains.gain_ladder(means).count() == 0


def test_tie_rounds_half_up(spark):
    assert rows(gains.gain_matrix(classes(spark, [("A", 34.1), ("B", 89.6)]))) == [("B", "A", -56.0)]


def test_ladder_telescopes_and_full_scale_has_21_pairs(spark):
    means = scenarios.reference_classes(spark)
    ladder = gains.gain_ladder(means).collect()
    assert len(ladder) == 6 and sum(r["gain_kWh_m2"] for r in ladder) == 550.0
    assert gains.better_pairs(means).count() == 21
    ranked = [r["saut"] for r in gains.ranked_ladder(means).collect()]
    assert ranked == ["G → F", "F → E", "E → D", "D → C", "C → B", "B → A"]
    assert {r["saut"]: r["gain_pct"] for r in ladder}["G → F"] == 25.0


def test_zero_mean_gives_no_percentage(spark):
    ladder = gains.gain_ladder(classes(spark, [("A", 1), ("B", 0)])).first()
    assert ladder["gain_pct"] is None and ladder["gain_kWh_m2"] == -1.0


def test_lookup_step_rejects_equal_and_worse(spark):
    means = scenarios.reference_classes(spark)
    assert gains.lookup_step(means, "E", "B").first()["gain_m2"] == 250.0
    assert gains.lookup_step(means, "B", "B").count() == 0
    assert gains.lookup_step(means, "B", "E").count() == 0


def dwellings(spark):
    cells = [("d1", "E", 80.0), ("d2", "A", 50.0), ("d3", None, 50.0)]
    return spark.createDataFrame(cells, "id string, grade string, s double")


def test_reference_scenario(spark):
    found = scenarios.reference_savings(dwellings(spark), scenarios.reference_classes(spark), ROLES)
    assert {r["id"] for r in found.collect()} == {"d1"} and found.count() == 4
    row = found.where("classe_cible = 'B'").first()
    assert row["econ_kwh"] == 20000.0 and row["econ_eur"] == pytest.approx(4600.0) and row["pct"] == 76
    assert row["amortissement"] == pytest.approx(3.26, abs=0.005)
    assert (row["total_avant"], row["total_apres"]) == (26400, 6400)
    assert scenarios.rounded_payback(found).where("classe_cible = 'B'").first()["amortissement"] == 3.3


def test_measured_scenario(spark):
    found = scenarios.class_savings(dwellings(spark), classes(spark, [("A", 40.0), ("E", 340.0)]), ROLES).collect()
    assert len(found) == 1
    assert found[0]["gain_m2"] == 300.0 and found[0]["gain_kwh"] == 24000.0
    assert found[0]["gain_euros"] == 6000.0 and found[0]["gain_co2"] == pytest.approx(840.0)


def test_class_kpis(spark):
    def table(pairs):
        return spark.createDataFrame(pairs, "grade string, nb_logements bigint, conso_moy_m2 double")

    full = stats.class_kpis(table([("A", 2, 50.5), ("G", 3, 600.0)]), ROLES).first()
    assert tuple(full) == (5, 600.0, 50.5, 550.0)
    assert stats.class_kpis(table([("G", 3, 600.0)]), ROLES).first()["gain_total"] == 0.0


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ABCDEFG"), st.floats(9, 1000)), min_size=1, max_size=25))
def test_scenario_property(spark, cells):
    """Every dwelling meets each strictly better grade once, and saving equals before minus after."""
    df = spark.createDataFrame([(str(i), g, s) for i, (g, s) in enumerate(cells)], "id string, grade string, s double")
    found = scenarios.reference_savings(df, scenarios.reference_classes(spark), ROLES).collect()
    assert len(found) == sum("ABCDEFG".index(g) for g, _ in cells)
    conso = dict(scenarios.CLASS_REFERENCE)
    for r in found:
        assert r["econ_kwh"] == (conso[r["grade"]] - conso[r["classe_cible"]]) * r["s"]
        assert r["total_avant"] == int(conso[r["grade"]] * r["s"])
