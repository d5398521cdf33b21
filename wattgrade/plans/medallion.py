"""Bronze to silver to gold, both generations of rules, one directory per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.functions.scalars import number
from wattgrade.operators import gains, models, quality, sampling, shaping, stats
from wattgrade.operators.features import COMMUNE_MEAN, model_rows
from wattgrade.roles import (
    ACCENTED_NAMES,
    CLASS_COLUMNS,
    CLASS_ROLES,
    CONSUMPTION_NAMES,
    MODEL_ROLES,
    SNAKE_NAMES,
)
from wattgrade.session import staged
from wattgrade.sources import messages, readers, records, versions, writers
from wattgrade.sources.schemas import CONSUMPTION_DOCUMENT, SNAKE_RECORD
from wattgrade.streaming import ingest


# Class analysis -----------------------------------------------------------------------------------------------------


def class_silver(raw: DataFrame) -> DataFrame:
    """Raw records of either layout, each renamed by what it holds, projected, one per key, checked and stamped."""
    renamed = records.merge_layouts(raw, ACCENTED_NAMES, SNAKE_NAMES)
    projected = shaping.project_present(renamed, CLASS_COLUMNS)
    return shaping.stamp(quality.clean_for_classes(projected, CLASS_ROLES))


def write_class_silver(
    spark: SparkSession, bronze: str, silver: str, rejected: str | None = None, versioned: bool = False
) -> Mapping[str, int]:
    """Class silver of all records, in either layout, enveloped or not; returns the counts of the read.

    ``versioned`` writes a new version beside the old one, which readers see until it is whole.

    The columns are text as in the static layouts, null where no record fills them, so the stored schema does not
    depend on the batch.
    """
    found = records.read_records(spark, bronze)
    raw = records.merge_layouts(records.to_columns(found), ACCENTED_NAMES, SNAKE_NAMES)
    raw = raw.select(
        *[(F.col(c) if shaping.present(raw, [c]) else F.lit(None)).cast("string").alias(c) for c in CLASS_COLUMNS]
    )
    write = versions.publish if versioned else writers.replace_partitioned
    write(class_silver(raw), silver, [CLASS_ROLES.grade])
    return keep_rejected(found, rejected)


def keep_rejected(found: records.Records, path: str | None) -> Mapping[str, int]:
    """Lines that are no record, with their place, as a table of their own where a path is given."""
    if path is not None:
        writers.overwrite(found.rejected, path)
    return found.counts


def explore_silver(silver: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Grade distribution and, where the column exists, the mean by building type."""
    by_building = None
    if shaping.present(silver, [CLASS_ROLES.building]):
        by_building = stats.mean_by(
            silver,
            CLASS_ROLES.building,
            CLASS_ROLES.intensity,
            "conso_moy",
            descending=True,
            keep_null_group=True,
        )
    return stats.grade_distribution(silver, CLASS_ROLES), by_building


def class_training_rows(silver: DataFrame) -> DataFrame:
    features = shaping.present(silver, [*CLASS_ROLES.numerics, *CLASS_ROLES.categoricals])
    columns = [CLASS_ROLES.key, *features, CLASS_ROLES.intensity]
    return quality.drop_incomplete_rows(silver.select(*columns), [*features, CLASS_ROLES.intensity])


def write_class_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    size: models.TreeSize = models.TreeSize(),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Statistics, gain matrix, ladder, forest and its predictions; returns the metrics."""
    rows = readers.read_dataset(spark, versions.current_path(spark, silver), schema)
    writers.overwrite(stats.class_stats(rows, CLASS_ROLES), f"{gold}/stats_par_classe")
    means = staged(gains.class_means(rows, CLASS_ROLES), "class-means")
    writers.overwrite(gains.gain_matrix(means), f"{gold}/matrice_gains")
    writers.overwrite(gains.gain_ladder(means), f"{gold}/dashboard_gains")

    learned = class_training_rows(rows)
    train, test = sampling.hashed_split(learned, CLASS_ROLES.key)
    categoricals = shaping.present(learned, CLASS_ROLES.categoricals)
    numerics = shaping.present(learned, CLASS_ROLES.numerics)
    fitted = models.train(
        train,
        CLASS_ROLES.intensity,
        categoricals,
        numerics,
        kinds=[models.FOREST],
        size=size,
        one_hot=True,
        keys=[CLASS_ROLES.key],
    )
    forest = fitted.whole(models.FOREST)
    test = fitted.ready(test)
    columns = [CLASS_ROLES.surface, CLASS_ROLES.ordinal, CLASS_ROLES.intensity]
    path = f"{gold}/predictions_classes"
    writers.overwrite(models.prediction_table(models.score(forest, test), columns), path)
    models.save_model(forest, f"{gold}/model_rf")
    return models.metrics_by_model(
        readers.read_dataset(spark, path), CLASS_ROLES.intensity, {models.FOREST: "prediction"}
    )


# Consumption model --------------------------------------------------------------------------------------------------


def dataset_rows(found: records.Records) -> DataFrame:
    """Records without blank and repeated rows, with every column that is filled anywhere: an empty one is not in the
    merged schema, so no further pass looks for it."""
    return quality.distinct_rows(quality.drop_blank_rows(records.to_columns(found)))


def write_dataset_silver(
    spark: SparkSession, bronze: str, silver: str, rejected: str | None = None
) -> Mapping[str, int]:
    """All columns of all records, enveloped or not; returns the counts of the read. Without a filled column there is
    nothing to write, and what is stored stays."""
    found = records.read_records(spark, bronze)
    if found.schema.fields:
        writers.overwrite_balanced(dataset_rows(found), silver)
    return keep_rejected(found, rejected)


def write_consumption_silver(
    spark: SparkSession, document: str, silver: str, schema: T.StructType = CONSUMPTION_DOCUMENT
) -> None:
    writers.overwrite(shaping.unwrap(readers.read_json_documents(spark, document, schema)), silver)


def commune_consumption(consumption: DataFrame) -> DataFrame:
    """Mean consumption per padded commune code, whether or not the records are still in their envelope."""
    flat = shaping.rename_present(shaping.unwrap_if_enveloped(consumption), CONSUMPTION_NAMES)
    return stats.commune_means(flat, "code_insee_join", "conso_reelle_mwh", COMMUNE_MEAN)


def write_model_gold(
    spark: SparkSession,
    diagnostics: str,
    consumption: str,
    gold: str,
    size: models.TreeSize = models.TreeSize(),
    flag_missing: bool = False,
) -> DataFrame:
    """Both models on the joined rows; writes the better one, its predictions and the metrics, which it returns."""
    carry = (MODEL_ROLES.zone, MODEL_ROLES.commune_name)
    means = commune_consumption(readers.read_dataset(spark, consumption))
    diagnosed = readers.read_dataset(spark, diagnostics)
    rows = staged(model_rows(diagnosed, MODEL_ROLES, means, flag_missing=flag_missing, carry=carry), "model-rows")
    train, test = sampling.hashed_split(rows, *(shaping.present(rows, [MODEL_ROLES.key]) or rows.columns))
    target = MODEL_ROLES.intensity
    numerics = shaping.present(rows, [*MODEL_ROLES.numerics, COMMUNE_MEAN, f"{COMMUNE_MEAN}_is_missing"])
    keys = shaping.present(rows, [MODEL_ROLES.key])
    fitted = models.train(train, target, shaping.present(rows, MODEL_ROLES.categoricals), numerics, size=size, keys=keys)

    scored = fitted.prepared(test)
    names = {models.FOREST: "_forest", models.BOOSTED: "_boosted"}
    for name, column in names.items():
        scored = fitted.models[name].copy({fitted.models[name].predictionCol: column}).transform(scored)
    values = [(r["model"], r["metric"], r["value"]) for r in models.metrics_by_model(scored, target, names).collect()]
    metrics = models.metrics_rows(spark, values)
    writers.overwrite(metrics, f"{gold}/metrics")

    best = models.best_model(metrics).first()["best_model"]
    columns = [
        MODEL_ROLES.commune,
        MODEL_ROLES.commune_name,
        MODEL_ROLES.grade,
        MODEL_ROLES.building,
        MODEL_ROLES.zone,
        MODEL_ROLES.surface,
        target,
    ]
    predictions = scored.withColumn("prediction", F.col(names[best]))
    writers.overwrite(models.prediction_table(predictions, columns), f"{gold}/predictions_modele")
    models.save_model(fitted.whole(best), f"{gold}/model")
    ranked = models.feature_importance(fitted, best, scored)
    writers.overwrite(models.importance_table(spark, ranked), f"{gold}/importance")
    return metrics


# Ingest and read path -----------------------------------------------------------------------------------------------


def start_ingest(spark: SparkSession, servers: str, topic: str, bronze: str, checkpoint: str, schema: T.StructType):
    """Topic to dated JSON lines; the writer is returned so that the caller sets the trigger and starts it."""
    decoded = messages.decode_rows(messages.topic_stream(spark, servers, topic), schema, readers.CORRUPT)
    dated = decoded.withColumn("date", F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
    return ingest.land(dated, bronze, checkpoint, by=["date"])


def write_sample(spark: SparkSession, bronze: str, path: str, schema: T.StructType = SNAKE_RECORD, n: int = 10) -> None:
    raw = readers.read_json_lines(spark, bronze, schema)
    writers.write_extract(raw, path, [MODEL_ROLES.key], n)


def prediction_reports(predictions: DataFrame) -> dict[str, DataFrame]:
    """The figures shown over the predictions, each present only where its columns are."""
    roles, target = MODEL_ROLES, MODEL_ROLES.intensity
    frame = predictions.withColumn(target, number(F.col(target)))
    reports = {
        "kpi": stats.prediction_kpis(frame, target, "prediction"),
        "grades": stats.group_counts(frame, roles.grade),
        "errors": models.error_by_group(frame, roles.grade, target, "prediction"),
        "bound": stats.axis_bound(frame, [target, "prediction"]),
    }
    if shaping.present(frame, [roles.zone]):
        reports["zones"] = stats.mean_by(frame, roles.zone, target, "conso", digits=4)
    if shaping.present(frame, [roles.commune_name]):
        reports["communes"] = stats.top_groups(frame, roles.commune_name, target, "conso")
    return reports
