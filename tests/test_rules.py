"""Row rules, codes, labels and numbers on literal edge rows."""

import math
import random
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from wattgrade.functions import scalars as S
from wattgrade.operators import quality, shaping, stats
from wattgrade.operators.joins import attach_commune_mean
from wattgrade.roles import GRADES, Roles

ROLES = Roles(key="id", received="day", grade="grade", ordinal="ord", intensity="x", surface="s", total="t")


def column(spark, expression, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_domain_keeps_exact_labels_and_normalising_widens_it(spark):
    values = ["A", "H", " a ", None]
    df = spark.createDataFrame([(v,) for v in values], "g string")
    assert rows(df.where(GRADES.contains(F.col("g")))) == [("A",)]
    assert column(spark, S.normalise_label, values, "string") == ["A", "H", "A", None]


def test_ordinal_is_int_and_null_off_the_scale(spark):
    df = spark.createDataFrame([("A",), ("G",), ("H",), (None,)], "g string")
    found = df.select(GRADES.ordinal(F.col("g")).alias("o"))
    assert found.schema["o"].dataType.simpleString() == "int"
    assert [r[0] for r in found.collect()] == [1, 7, None, None]


def test_closed_and_open_ranges(spark):
    cells = [(x, 50.0) for x in (-1.0, 0.0, 2000.0, 2000.1)] + [(5.0, s) for s in (8.9, 9.0, 1000.0, 1001.0)]
    df = spark.createDataFrame(cells, "x double, s double")
    assert rows(df.where(quality.in_ranges(ROLES))) == sorted(
        [(0.0, 50.0), (2000.0, 50.0), (5.0, 9.0), (5.0, 1000.0)], key=repr
    )
    target = spark.createDataFrame([(0.0,), (0.1,), (1999.9,), (2000.0,), (None,), (math.nan,)], "x double")
    assert rows(target.where(quality.in_target_range(ROLES))) == [(0.1,), (1999.9,)]


def test_pad_code(spark):
    found = column(spark, S.pad_code, ["1001", "01001", "2A004", "1001.0", "123456", None], "string")
    assert found == ["01001", "01001", "2A004", "01001", "123456", None]
    assert column(spark, S.pad_code, [1001.0, 75056.0, 1e7, 12345678.0], "double") == ["01001", "75056", "10000000", "12345678"]


def test_fills(spark):
    values = [None, "", "abc", "1.5"]
    assert column(spark, S.fill_unknown, values, "string") == ["Inconnu", "", "abc", "1.5"]
    assert column(spark, S.fill_number, values, "string") == [0.0, 0.0, 0.0, 1.5]


def test_half_up_rounds_once_and_keeps_special_values(spark):
    values = [2.675, 12.3499999999, -0.125, math.inf, None, 12.34125 - 1e-13]
    found = column(spark, lambda v: S.half_up(v, 2), values, "double")
    assert found == [2.68, 12.35, -0.13, math.inf, None, 12.34]
    assert column(spark, lambda v: S.half_up(v, 1), [12.3499999999, 12.35], "double") == [12.3, 12.4]
    assert column(spark, lambda v: S.half_up(v, 4), [12.34125, 12.34125 - 1e-13], "double") == [12.3413, 12.3412]
    assert math.isnan(column(spark, lambda v: S.half_up(v, 2), [math.nan], "double")[0])


def once(total, n, digits):
    """Half away from zero of an exact fraction."""
    scaled = abs(Fraction(total)) * 10**digits / n
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return math.copysign(whole / 10**digits, total) if whole else 0.0


@pytest.mark.parametrize("digits", [0, 1, 4])
def test_means_and_sums_are_exact_before_they_are_rounded(spark, digits):
    draw = random.Random(digits)
    groups = {
        "tie": [12.1, 12.2, 12.3, 12.2, -0.05],
        "mixed": [1.0, -0.2, 0.7, -1.5],
        "negative": [-0.1, -0.15, -3.35],
        "cancel": [1e15, 0.25, -1e15, 0.1],
        "zero": [0.1, -0.1],
        "wide": [draw.choice([-1, 1]) * round(draw.random() * 10 ** draw.randint(0, 9), draw.randint(0, 6)) for _ in range(500)],
        "near": [12.3499999999] * 3 + [None],
        "tiny": [1e-17, 4e-18, 0.05],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(6)
    found = df.groupBy("g").agg(S.rounded_mean(F.col("v"), digits).alias("m"), S.rounded_sum(F.col("v"), digits).alias("s"))
    for r in found.collect():
        kept = [Fraction(repr(v)) for v in groups[r["g"]] if v is not None]
        assert r["m"] == once(sum(kept), len(kept), digits) and r["s"] == once(sum(kept), 1, digits), r


def test_means_of_special_values(spark):
    rows_in = [("none", None), ("inf", math.inf), ("inf", 1.0), ("nan", math.nan), ("nan", 2.0), ("huge", 1e25), ("huge", 3e25)]
    df = spark.createDataFrame(rows_in, "g string, v double")
    found = df.groupBy("g").agg(S.rounded_mean(F.col("v"), 1).alias("m"), S.rounded_sum(F.col("v"), 1).alias("s"))
    got = {r["g"]: (r["m"], r["s"]) for r in found.collect()}
    assert got["none"] == (None, None) and got["inf"] == (math.inf, math.inf) and math.isnan(got["nan"][0])
    assert got["huge"] == (2e25, 4e25)
    empty = df.limit(0).agg(S.rounded_mean(F.col("v"), 1).alias("m"), S.rounded_sum(F.col("v"), 1).alias("s")).first()
    assert tuple(empty) == (None, None)


def test_ratio_base_name_and_step(spark):
    df = spark.createDataFrame([(1.0, 0.0, "a/b/c.csv")], "a double, b double, p string")
    found = df.select(
        S.safe_ratio(F.col("a"), F.col("b")), S.base_name(F.col("p")), S.step_label(F.lit("G"), F.lit("F"))
    )
    assert rows(found) == [(None, "c.csv", "G → F")]


def test_blank_rows_and_empty_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, None), (1, "a", None)], "i int, c string, e string")
    assert rows(quality.clean_dataset(df)) == [(1, "a")]
    report = quality.dataset_report(df).first().asDict()
    assert report == {"rows_before": 3, "removed_blank": 1, "removed_repeated": 1, "rows_after": 1}


def test_dedupe_takes_latest_then_larger(spark):
    df = spark.createDataFrame(
        [
            ("k", "2024-01-01", "A", 9.0, 9.0, 9.0),
            ("k", "2024-01-02", "A", 1.0, 1.0, 1.0),
            ("k", "2024-01-02", "A", 2.0, 1.0, 1.0),
            (None, "2024-01-01", "B", 1.0, 1.0, 1.0),
            (None, None, "C", 1.0, 1.0, 1.0),
        ],
        "id string, day string, grade string, x double, t double, s double",
    )
    kept = quality.latest_per_key(df, "id", ROLES.survivor_order(df.columns))
    assert kept.columns == df.columns
    assert rows(kept.select("id", "day", "x")) == sorted(
        [("k", "2024-01-02", 2.0), (None, "2024-01-01", 1.0)], key=repr
    )


def diagnostic_rows(spark):
    return spark.createDataFrame(
        [
            ("a", "2024-01-01", "A", "50.0", "4000", "80"),
            ("a", "2024-01-02", "A", "60.0", "4800", "80"),
            ("b", "2024-01-01", "H", "60.0", "4800", "80"),
            ("c", "2024-01-01", "B", "oops", "4800", "80"),
            ("d", "2024-01-01", "C", "2000.1", "4800", "80"),
            ("e", "2024-01-01", None, "100", "4800", "80"),
            ("f", "2024-01-01", "G", "2000", "4800", "9"),
        ],
        "id string, day string, grade string, x string, t string, s string",
    )


def test_clean_and_its_report_agree_and_the_clean_is_idempotent(spark):
    raw = diagnostic_rows(spark)
    clean = quality.clean_for_classes(raw, ROLES)
    assert rows(clean.select("id", "x", "ord")) == [("a", 60.0, 1), ("f", 2000.0, 7)]
    again = quality.clean_for_classes(clean.drop("ord"), ROLES)
    assert rows(again) == rows(clean)
    report = quality.cleaning_report(raw, ROLES).first().asDict()
    removed = [v for k, v in report.items() if k.startswith("removed_")]
    assert report["rows_before"] == 7 and report["rows_after"] == clean.count()
    assert report["rows_before"] == report["rows_after"] + sum(removed) and report["rows_removed"] == sum(removed)
    assert [report[k] for k in ("removed_repeated_key", "removed_incomplete", "removed_off_scale",
                                "removed_out_of_range")] == [1, 2, 1, 1]


def test_reports_of_an_empty_frame(spark):
    empty = diagnostic_rows(spark).limit(0)
    assert set(quality.cleaning_report(empty, ROLES).first()) == {0}
    assert set(quality.dataset_report(empty).first()) == {0}


def test_envelopes(spark):
    narrow = spark.sql("select 'f' as source_file, named_struct('a', 1, 'b', 'x') as data")
    wide = spark.sql("select 1 as p, 2 as q, 3 as r, named_struct('a', 1, 'b', 'x') as data")
    plain = spark.sql("select 1 as a, 'x' as b")
    several = spark.sql("select array(named_struct('a', 1), named_struct('a', 2)) as data")
    assert rows(shaping.unwrap_if_enveloped(narrow, max_outer=3)) == [(1, "x")]
    assert shaping.unwrap_if_enveloped(wide, max_outer=3).columns == wide.columns
    assert rows(shaping.unwrap_if_enveloped(wide)) == [(1, "x")]
    assert rows(shaping.unwrap_if_enveloped(plain)) == [(1, "x")]
    assert rows(shaping.unwrap(several)) == [(1,), (2,)]


def test_tolerant_projection_and_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Code Commune", "a.b", "C"])
    assert shaping.project_present(df, ["c", "nope", "a.b"]).columns == ["c", "a.b"]
    assert shaping.rename_present(df, {"Code Commune": "code", "nope": "x"}).columns == ["code", "a.b", "C"]
    assert shaping.drop_empty_columns(df).columns == df.columns


def test_left_join_keeps_every_record_and_pads_both_sides(spark):
    cells = [("r1", "1001"), ("r2", "2A004"), ("r3", None), ("r4", "1001")]
    records = spark.createDataFrame(cells, "r string, code string")
    use = spark.createDataFrame([(1001, "2.0"), (1001, "4.0"), (1001, "bad"), (9, "1.0")], "c bigint, v string")
    means = stats.commune_means(use, "c", "v", "mean")
    for stage in (True, False):
        joined = attach_commune_mean(records, "code", means, "c", stage=stage)
        assert rows(joined) == sorted(
            [("r1", "01001", 3.0), ("r2", "2A004", None), ("r3", None, None), ("r4", "01001", 3.0)], key=repr
        )


def test_group_total_counts_the_null_group_both_ways(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "g string")
    assert stats.group_total(df, "g", "n").first()[0] == 3
    assert stats.group_total(df, "g", "n", approximate=True).first()[0] == 3


def test_axis_bound_minimum_group_and_top(spark):
    cells = [("a", 1.0, 5.0), ("a", 2.0, 1.0), ("b", 9.0, None), (None, 99.0, 1.0)]
    df = spark.createDataFrame(cells, "g string, x double, y double")
    assert stats.axis_bound(df, ["x", "y"]).first()[0] == 99.0
    assert rows(stats.groups_larger_than(df, "g", 1)) == [("a", 2)]
    assert rows(stats.top_groups(df, "g", "x", "m", n=1)) == [("b", 9.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789AB", min_size=0, max_size=8), min_size=1, max_size=40))
def test_padding_property(spark, codes):
    for code, padded in zip(codes, column(spark, S.pad_code, codes, "string")):
        assert padded == code.rjust(5, "0")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.sampled_from([*"ABCDEFGH", "", "a"])), min_size=1, max_size=40))
def test_ordinal_property(spark, labels):
    expected = [("ABCDEFG".index(g) + 1) if g in list("ABCDEFG") else None for g in labels]
    assert column(spark, GRADES.ordinal, labels, "string") == expected
