"""Feature preparation for the regressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattgrade.functions.scalars import fill_number, fill_unknown, normalise_label, number, pad_code
from wattgrade.operators.joins import attach_commune_mean
from wattgrade.operators.quality import in_target_range
from wattgrade.operators.shaping import present
from wattgrade.roles import Roles

COMMUNE_MEAN = "conso_moyenne_commune_mwh"
# Labels up to which a column is a category of its own bins; beyond it its frequency rank is a number.
MAX_CATEGORIES = 1000


def model_rows(
    records: DataFrame,
    roles: Roles,
    commune_means: DataFrame | None = None,
    means_code: str = "code_insee_join",
    flag_missing: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows ready for training: codes padded, commune mean attached, target checked, gaps filled.

    ``carry`` names columns that are no features but belong in the prediction table. ``flag_missing`` adds an
    indicator that tells a commune without a mean from one whose mean is zero.
    """
    numerics = list(roles.numerics)
    wanted = [roles.key, roles.commune, *roles.categoricals, *numerics, roles.intensity, *carry]
    names = list(dict.fromkeys(present(records, [c for c in wanted if c])))
    df = records.select(*names).withColumn(roles.intensity, number(F.col(roles.intensity)))
    df = df.where(in_target_range(roles))
    if commune_means is not None:
        df = attach_commune_mean(df, roles.commune, commune_means, means_code)
        if flag_missing:
            df = df.withColumn(f"{COMMUNE_MEAN}_is_missing", F.col(COMMUNE_MEAN).isNull().cast("double"))
        numerics.append(COMMUNE_MEAN)
    elif roles.commune and roles.commune in df.columns:
        df = df.withColumn(roles.commune, pad_code(F.col(roles.commune)))
    changes = {}
    for c in present(df, roles.categoricals):
        label = normalise_label(F.col(c)) if c == roles.grade else F.col(c)
        changes[c] = fill_unknown(label)
    for c in present(df, numerics):
        changes[c] = fill_number(F.col(c))
    return df.withColumns(changes)


def indexer(categoricals: Sequence[str]) -> StringIndexer:
    """All columns in one pass, labels by falling frequency and then by name; unseen labels get their own index."""
    return StringIndexer(
        inputCols=list(categoricals),
        outputCols=[f"{c}_idx" for c in categoricals],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def fit_preparation(
    train: DataFrame, categoricals: Sequence[str], numerics: Sequence[str], one_hot: bool = False
) -> PipelineModel:
    """Index, optionally one-hot encode, and assemble, fitted once for every model that follows."""
    stages = []
    encoded: list[str] = []
    if categoricals:
        stages.append(indexer(categoricals))
        encoded = [f"{c}_idx" for c in categoricals]
    if one_hot and categoricals:
        stages.append(OneHotEncoder(inputCols=encoded, outputCols=[f"{c}_enc" for c in categoricals]))
        encoded = [f"{c}_enc" for c in categoricals]
    features = list(numerics) + encoded if one_hot else encoded + list(numerics)
    stages.append(VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def bins_needed(preparation: PipelineModel, one_hot: bool = False, floor: int = 32) -> int:
    """Trees need a bin for every label and one for unseen ones."""
    sizes = [len(l) for s in preparation.stages if isinstance(s, StringIndexerModel) for l in s.labelsArray]
    return floor if one_hot else max([floor] + [n + 1 for n in sizes])
