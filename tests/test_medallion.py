"""Both generations end to end on small raw files."""

import json

import numpy as np
from pyspark.sql import functions as F

from tests.helpers import rows
from wattgrade.__main__ import parser
from wattgrade.operators import models
from wattgrade.plans import medallion
from wattgrade.roles import ACCENTED_NAMES, MODEL_ROLES
from wattgrade.sources import readers, versions
from wattgrade.sources.schemas import SNAKE_RECORD

SMALL = models.TreeSize(trees=3, depth=3)


def raw_records(n=300):
    rng = np.random.default_rng(5)
    for i in range(n):
        g = int(rng.integers(0, 7))
        yield i, "ABCDEFG"[g], float(60 * (g + 1) + rng.integers(0, 20)), float(rng.integers(20, 150))


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")


def test_class_analysis(spark, tmp_path):
    names = list(ACCENTED_NAMES)
    records = []
    for i, grade, x, s in raw_records():
        kind = ["maison", "immeuble"][i % 2]
        values = [f"N{i}", "2024-01-01", grade, grade, x * s, x, s, kind, "1975", "gaz", "75001", 5]
        records.append(dict(zip(names, values)) | {"other": 1})
    older = records[0] | {"Date_réception_DPE": "2023-01-01", "Etiquette_DPE": "A"}
    off_scale = records[1] | {"N°DPE": "bad", "Etiquette_DPE": "Z"}
    records += [older, off_scale]
    write_lines(tmp_path / "bronze" / "date=2024-01-01" / "part" / "a.json", records)
    silver, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    medallion.write_class_silver(spark, f"{tmp_path}/bronze", silver)
    clean = readers.read_dataset(spark, silver)
    assert clean.count() == 300 and {"Etiquette_DPE", "Etiquette_DPE_num", "_silver_timestamp"} <= set(clean.columns)
    distribution, by_building = medallion.explore_silver(clean)
    assert distribution.agg(F.sum("nb")).first()[0] == 300 and by_building.count() == 2

    metrics = medallion.write_class_gold(spark, silver, gold, SMALL)
    assert {r["metric"] for r in metrics.collect()} == {"RMSE", "R2"}
    assert readers.read_dataset(spark, f"{gold}/stats_par_classe").count() == 7
    assert readers.read_dataset(spark, f"{gold}/matrice_gains").count() == 21
    assert readers.read_dataset(spark, f"{gold}/dashboard_gains").count() == 6
    assert len(readers.read_dataset(spark, f"{gold}/predictions_classes").columns) == 4
    assert models.load_model(f"{gold}/model_rf")

    versioned = f"{tmp_path}/versioned"
    for _ in range(2):
        medallion.write_class_silver(spark, f"{tmp_path}/bronze", versioned, versioned=True)
    assert versions.versions(spark, versioned).count() == 2
    names = [c for c in clean.columns if c != "_silver_timestamp"]
    assert rows(versions.read_current(spark, versioned).select(names)) == rows(clean.select(names))


def test_snake_layout_gives_the_same_silver(spark):
    df = spark.createDataFrame(
        [("n1", "2024-01-01", "A", "4000", "50", "80")],
        "numero_dpe string, date_reception_dpe string, etiquette_dpe string, conso_5_usages_ef string, "
        "conso_5_usages_par_m2_ef string, surface_habitable_logement string",
    )
    found = medallion.class_silver(df).drop("_silver_timestamp")
    assert rows(found) == [("n1", "2024-01-01", "A", 4000.0, 50.0, 80.0, 1)]


def test_consumption_model(spark, tmp_path):
    records = []
    for i, grade, x, s in raw_records():
        records.append(
            {
                "numero_dpe": f"N{i}",
                MODEL_ROLES.grade: grade.lower() + " ",
                "type_batiment": ["maison", None][i % 2],
                "zone_climatique": ["H1a", "H3"][i % 2],
                "code_insee_ban": str(1001 + i % 3),
                "nom_commune_ban": ["Lyon", "Lens", "Nancy"][i % 3],
                "surface_habitable_immeuble": s,
                MODEL_ROLES.intensity: x,
            }
        )
    write_lines(tmp_path / "bronze" / "batch_1.json", records[:150])
    write_lines(tmp_path / "bronze" / "batch_2.json", records[150:] + records[-10:])
    name = "consommation_annuelle_moyenne_par_site_de_ladresse_mwh"
    document = [{"data": {"Code Commune": 1001, name: 4.0}}, {"data": {"Code Commune": "01001", name: "6.0"}}]
    (tmp_path / "conso.json").write_text(json.dumps(document))

    medallion.write_dataset_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/dpe")
    medallion.write_consumption_silver(spark, f"{tmp_path}/conso.json", f"{tmp_path}/conso")
    silver = readers.read_dataset(spark, f"{tmp_path}/dpe")
    assert silver.count() == 300 and "qualite_isolation_murs" not in silver.columns
    means = medallion.commune_consumption(readers.read_dataset(spark, f"{tmp_path}/conso"))
    assert rows(means) == [("01001", 5.0)]

    gold = f"{tmp_path}/gold"
    metrics = medallion.write_model_gold(spark, f"{tmp_path}/dpe", f"{tmp_path}/conso", gold, SMALL, flag_missing=True)
    assert metrics.count() == 4
    predictions = readers.read_dataset(spark, f"{gold}/predictions_modele")
    assert {"zone_climatique", "nom_commune_ban", "prediction"} <= set(predictions.columns)
    reports = medallion.prediction_reports(predictions)
    assert set(reports) == {"kpi", "grades", "errors", "bound", "zones", "communes"}
    assert reports["kpi"].first()["nb_logements"] == predictions.count()
    best = models.best_model(readers.read_dataset(spark, f"{gold}/metrics")).first()
    assert abs(best["rmse"] - reports["kpi"].first()["rmse"]) < 1e-3
    assert models.load_model(f"{gold}/model")
    assert readers.read_dataset(spark, f"{gold}/importance").count() == 6

    medallion.write_sample(spark, f"{tmp_path}/bronze", f"{tmp_path}/sample")
    assert readers.read_delimited(spark, f"{tmp_path}/sample", SNAKE_RECORD.names, sep=",").count() == 10


def test_enveloped_records_give_the_same_silver(spark, tmp_path):
    records = [{"numero_dpe": f"N{i}", "etiquette_dpe": "A", "code_insee_ban": str(i)} for i in range(20)]
    write_lines(tmp_path / "flat" / "a.json", records)
    write_lines(tmp_path / "wrapped" / "a.json", [{"source_file": "a.csv", "data": r} for r in records + records[:3]])
    medallion.write_dataset_silver(spark, f"{tmp_path}/flat", f"{tmp_path}/out1")
    medallion.write_dataset_silver(spark, f"{tmp_path}/wrapped", f"{tmp_path}/out2")
    first, second = readers.read_dataset(spark, f"{tmp_path}/out1"), readers.read_dataset(spark, f"{tmp_path}/out2")
    assert first.count() == 20 and sorted(first.columns) == ["code_insee_ban", "etiquette_dpe", "numero_dpe"]
    assert rows(first) == rows(second.select(*first.columns))


def test_job_options():
    args = parser().parse_args(["class-silver", "--bronze", "b", "--silver", "s", "--rejected", "r"])
    assert (args.job, args.bronze, args.rejected) == ("class-silver", "b", "r")


def test_all_filled_columns_and_rejected_lines(spark, tmp_path):
    records = [{"numero_dpe": f"N{i}", "etiquette_dpe": "A", "étage": i % 3, "vide": None} for i in range(20)]
    write_lines(tmp_path / "bronze" / "a.json", [*records, records[0], {"etiquette_dpe": None}, 17, records[1] | {"étage": 9}])
    with (tmp_path / "bronze" / "a.json").open("a", encoding="utf-8") as file:
        file.write('\n\n{"numero_dpe": \n')
    counts = medallion.write_dataset_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/out", f"{tmp_path}/rejected")
    assert counts == {"n_lines": 25, "n_records": 23, "n_rejected": 2}
    silver = readers.read_dataset(spark, f"{tmp_path}/out")
    # Rows that differ only in a column that no list names stay apart; a blank record and an empty column go.
    assert silver.count() == 21 and sorted(silver.columns) == ["etiquette_dpe", "numero_dpe", "étage"]
    rejected = readers.read_dataset(spark, f"{tmp_path}/rejected").drop("block_start")
    assert rows(rejected) == [("a.json", 22, "no record", "17"), ("a.json", 25, "malformed", '{"numero_dpe": ')]
    (tmp_path / "none").mkdir()
    assert medallion.write_dataset_silver(spark, f"{tmp_path}/none", f"{tmp_path}/out")["n_records"] == 0
    assert readers.read_dataset(spark, f"{tmp_path}/out").count() == 21


def test_class_silver_of_mixed_layouts_and_envelopes(spark, tmp_path):
    accented = dict(zip(ACCENTED_NAMES, ["n1", "2024-01-01", "A", "A", 4000, 50, 80.5, "maison", "1975", "gaz", 75001, 5]))
    snake = {"numero_dpe": "n2", "date_reception_dpe": "2024-01-02", "etiquette_dpe": "B", "conso_5_usages_ef": "9000"}
    snake |= {"conso_5_usages_par_m2_ef": 90, "surface_habitable_logement": 100, "code_postal_ban": "01000"}
    later = snake | {"date_reception_dpe": "2024-02-02", "etiquette_dpe": "C"}
    write_lines(tmp_path / "b" / "x.json", [accented, {"source_file": "f", "data": snake}, {"data": [later, later]}, "text"])
    assert medallion.write_class_silver(spark, f"{tmp_path}/b", f"{tmp_path}/s", f"{tmp_path}/r")["n_rejected"] == 1
    silver = readers.read_dataset(spark, f"{tmp_path}/s")
    got = rows(silver.select("N_DPE", "Etiquette_DPE", "Conso_5_usages_e_finale", "Surface_habitable_logement", "Code_postal_ban"))
    assert got == [("n1", "A", 4000.0, 80.5, "75001"), ("n2", "C", 9000.0, 100.0, "01000")]
