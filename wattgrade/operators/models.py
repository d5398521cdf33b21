"""Tree regressions, their metrics and the choice between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrade.functions.scalars import half_up, squared_error
from wattgrade.operators.cells import DRAW, ROWS, at_least, cells_of
from wattgrade.operators.features import MAX_CATEGORIES, bins_needed, fit_preparation
from wattgrade.operators.labels import label_sizes, label_table, with_label_ranks
from wattgrade.operators.sampling import hashed_share
from wattgrade.operators.stats import r_squared, rmse
from wattgrade.session import shared_root, staged

FOREST, BOOSTED = "RandomForest", "GBT"
# Rows that one partition of the training rows holds at most, on average.
PARTITION_ROWS = 500_000
# A forest draws single rows whatever the size of the table. A number here, which no query gives, is the rows up to which
# it does; beyond, it draws so many parts of each cell.
SINGLE_ROWS, CELL_DRAWS = None, 8


@dataclass(frozen=True)
class TreeSize:
    """Sizes of the fit. Trees follow the number of partitions, which is stated and not taken from the cluster; only the
    number of rows raises it (``PARTITION_ROWS``)."""

    # Trees, depth and seed of the published models.

    trees: int = 50
    depth: int = 8
    seed: int = 42
    partitions: int = 16


@dataclass(frozen=True)
class FittedModels:
    """``ranks`` is the label table of the columns in ``ranked``, whose frequency ranks are features; rows to be scored
    get them first."""

    preparation: PipelineModel
    models: Mapping[str, Model]
    ranks: DataFrame | None = None
    ranked: Sequence[str] = ()

    def ready(self, rows: DataFrame) -> DataFrame:
        return with_label_ranks(rows, self.ranks, self.ranked) if self.ranked else rows

    def prepared(self, rows: DataFrame) -> DataFrame:
        return self.preparation.transform(self.ready(rows))

    def whole(self, name: str) -> PipelineModel:
        """Preparation and regression as one saveable model."""
        return PipelineModel(stages=[*self.preparation.stages, self.models[name]])


def laid_out(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """A stated number of partitions by the hash of the keys, sorted inside: the same rows in the same places on every
    cluster, so what samples by partition draws the same rows. Spark does not merge stated partitions."""
    names = [f"`{k}`" for k in keys]
    hashed = F.xxhash64(*names)
    return df.repartition(partitions, hashed).sortWithinPartitions(hashed, *names)


def partitions_for(rows: int, least: int) -> int:
    """``least`` partitions, and more where these would hold more than ``PARTITION_ROWS`` rows."""
    return max(least, -(-rows // PARTITION_ROWS))


def train(
    rows: DataFrame,
    target: str,
    categoricals: Sequence[str],
    numerics: Sequence[str],
    kinds: Sequence[str] = (FOREST, BOOSTED),
    size: TreeSize = TreeSize(),
    one_hot: bool = False,
    keys: Sequence[str] = (),
    max_rows: int | None = None,
    max_categories: int = MAX_CATEGORIES,
) -> FittedModels:
    """Fit the preparation once, keep its output, and fit every requested model on it.

    ``rows`` should come from a stored table (``session.staged``): fitting reads them several times. They are laid out
    by ``keys`` (default: all columns) in ``size.partitions`` partitions, so the fit does not depend on the cluster.
    ``max_rows`` is about how many rows are learned from, drawn by the hash of the keys. A column with more than
    ``max_categories`` labels is no category; the frequency rank of its label is a number. Boosting fits cells of rows
    that no tree can tell apart, by their number and mean target (``cells``), and cuts its lineage in the checkpoint
    folder every ten trees. The forest draws single rows at any size, unless ``SINGLE_ROWS`` is set.
    """
    shared_root(rows.sparkSession)
    keys = list(keys) or rows.columns
    if max_rows is not None:
        rows = staged(hashed_share(rows, keys, max_rows), "bounded-rows")
    ranks = staged(label_table(rows, categoricals), "labels") if categoricals else None
    sizes = label_sizes(ranks, categoricals) if categoricals else {}
    ranked = [c for c in categoricals if sizes[c] > max_categories]
    categoricals = [c for c in categoricals if c not in ranked]
    numerics = [*numerics, *[f"{c}_rank" for c in ranked]]
    if ranked:
        rows = staged(with_label_ranks(rows, ranks, ranked), "ranked-rows")
    preparation = fit_preparation(rows, categoricals, numerics, one_hot)
    bins = bins_needed(preparation, one_hot)
    common = dict(
        featuresCol="features",
        labelCol=target,
        maxDepth=size.depth,
        maxBins=bins,
        seed=size.seed,
        checkpointInterval=10,
    )

    def fitted(regressor, learned: DataFrame, keys: Sequence[str], *weights: str) -> Model:
        placed = laid_out(learned, keys, partitions_for(learned.count(), size.partitions))
        prepared = preparation.transform(placed).select(target, *weights, "features").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return regressor.fit(prepared)
        finally:
            prepared.unpersist()

    def cells(*draws) -> DataFrame:
        return at_least(staged(cells_of(rows, target, categoricals, numerics, bins, *draws), "cells"), bins)

    models = {}
    for kind in kinds:
        if kind == FOREST and (SINGLE_ROWS is None or rows.count() <= SINGLE_ROWS):
            models[kind] = fitted(RandomForestRegressor(numTrees=size.trees, **common), rows, keys)
        elif kind == FOREST:
            forest = RandomForestRegressor(numTrees=size.trees, weightCol=ROWS, **common)
            models[kind] = fitted(forest, cells(CELL_DRAWS, keys), [*categoricals, *numerics, DRAW], ROWS)
        else:
            boosting = GBTRegressor(maxIter=size.trees, weightCol=ROWS, **common)
            models[kind] = fitted(boosting, cells(), [*categoricals, *numerics], ROWS)
    return FittedModels(preparation, models, ranks, ranked)


def score(model: Transformer, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def prediction_table(scored: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = {c.lower() for c in scored.columns}
    return scored.select(*[c for c in columns if c.lower() in names], "prediction")


def metrics_by_model(
    scored: DataFrame, target: str, predictions: Mapping[str, str], digits: int = 6
) -> DataFrame:
    """(model, metric, value): RMSE and R² of every prediction column from one pass."""
    aggregates, rows = [], []
    for i, (name, column) in enumerate(predictions.items()):
        actual, predicted = F.col(target), F.col(column)
        for metric, value in (("RMSE", rmse(actual, predicted)), ("R2", r_squared(actual, predicted))):
            aggregates.append(half_up(value, digits).alias(f"{metric}_{i}"))
            rows.append(
                F.struct(
                    F.lit(name).alias("model"), F.lit(metric).alias("metric"), F.col(f"{metric}_{i}").alias("value")
                )
            )
    return scored.agg(*aggregates).select(F.inline(F.array(*rows)))


def metrics_rows(spark: SparkSession, values: Sequence[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame(list(values), "model string, metric string, value double")


def best_model(metrics: DataFrame, challenger: str = BOOSTED, default: str = FOREST) -> DataFrame:
    """The challenger only when its RMSE is strictly lower, otherwise the default."""

    def value(model: str, metric: str):
        return F.max(F.when((F.col("model") == model) & (F.col("metric") == metric), F.col("value")))

    wins = F.coalesce(value(challenger, "RMSE") < value(default, "RMSE"), F.lit(False))
    return metrics.agg(
        F.when(wins, challenger).otherwise(default).alias("best_model"),
        F.when(wins, value(challenger, "RMSE")).otherwise(value(default, "RMSE")).alias("rmse"),
        F.when(wins, value(challenger, "R2")).otherwise(value(default, "R2")).alias("r2"),
    )


def error_by_group(scored: DataFrame, by: str, target: str, prediction: str, digits: int = 4) -> DataFrame:
    return scored.groupBy(by).agg(
        F.count("*").alias("nb"),
        half_up(F.sqrt(F.avg(squared_error(F.col(target), F.col(prediction)))), digits).alias("rmse"),
        half_up(F.max(target), digits).alias("max_reel"),
        half_up(F.max(prediction), digits).alias("max_predit"),
    )


def feature_importance(fitted: FittedModels, name: str, prepared: DataFrame) -> list[tuple[int, str, float]]:
    """(rank, variable, importance): slots of an encoded variable are added up. Bounded by the feature vector."""
    attributes = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    assembler = fitted.preparation.stages[-1]
    weights = fitted.models[name].featureImportances
    totals = {c: 0.0 for c in assembler.getInputCols()}
    for group in attributes.values():
        for slot in group:
            owners = [c for c in totals if slot["name"] == c or slot["name"].startswith(f"{c}_")]
            totals[max(owners, key=len)] += float(weights[slot["idx"]])
    names = {c: c.removesuffix("_idx").removesuffix("_enc") for c in totals}
    ordered = sorted(totals.items(), key=lambda item: (-item[1], item[0]))
    return [(rank, names[c], weight) for rank, (c, weight) in enumerate(ordered, start=1)]


def importance_table(spark: SparkSession, ranked: Sequence[tuple[int, str, float]]) -> DataFrame:
    return spark.createDataFrame(list(ranked), "rank int, variable string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
