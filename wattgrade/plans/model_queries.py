"""Queries on the regressions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattgrade.functions.scalars import half_up, rounded_mean
from wattgrade.operators import models, sampling, scenarios, stats
from wattgrade.operators.features import COMMUNE_MEAN, fit_preparation, model_rows
from wattgrade.operators.labels import label_table, with_label_ranks
from wattgrade.operators.quality import drop_incomplete_rows
from wattgrade.plans.clean_queries import class_rows
from wattgrade.plans.mapping import CLASSED, IS_TRAIN, MODEL, ROLES, STAND_IN, consumption, diagnostics, table
from wattgrade.plans.registry import query
from wattgrade.plans.stats_queries import rounded
from wattgrade.roles import GRADES
from wattgrade.session import staged, work_path
from wattgrade.sources import readers

TARGET = ROLES.intensity
NUMERICS = (*ROLES.numerics, COMMUNE_MEAN)
TABLE_COLUMNS = ("commune", "commune_name", "grade", "building", "zone", "surface", TARGET)


def prepared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = stats.commune_means(consumption(spark, sf_dir), "code_insee_join", "conso_reelle_mwh", COMMUNE_MEAN)
    return model_rows(diagnostics(spark, sf_dir), ROLES, means, carry=("commune_name",))


_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part", "events")
_kept: dict[tuple, object] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, lengths and times of the tables' files."""
    parts = []
    for t in _TABLES:  # one row a table
        files = readers.list_files(spark, f"{sf_dir}/{t}.parquet")
        seen = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime"), F.sum(F.xxhash64("path") % 1_000_003))
        parts.append(tuple(seen.first()))
    return (spark.sparkContext.applicationId, sf_dir, *parts)


def _once(state: tuple, name: str, make):
    """What is made of these very files, once: other names, lengths or times of the tables' files make another."""
    key = (name, *state)
    if key not in _kept:
        for old in [k for k in _kept if k[:3] == key[:3]]:
            del _kept[old]
        _kept[key] = make()
    return _kept[key]


def model_table(spark: SparkSession, sf_dir: str, state: tuple) -> DataFrame:
    """The prepared rows and whether they are learned from, so that fits and scores need not hash each key again."""
    learned = sampling.in_training(ROLES.key).alias("_learned")
    return _once(state, "rows", lambda: staged(prepared_rows(spark, sf_dir).select("*", learned), "model-rows"))


_KINDS = (models.FOREST, models.BOOSTED)


def fitted(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = _KINDS) -> tuple[models.FittedModels, DataFrame]:
    """The wanted models at full size, each fitted once, and the test rows."""
    state = _state(spark, sf_dir)
    rows = model_table(spark, sf_dir, state)
    train, test = rows.where("_learned").drop("_learned"), rows.where("not _learned").drop("_learned")

    def fit(kind):
        return models.train(train, TARGET, ROLES.categoricals, NUMERICS, [kind], keys=[ROLES.key])

    found = [_once(state, kind, lambda: fit(kind)) for kind in kinds]
    return replace(found[0], models={k: m for one in found for k, m in one.models.items()}), test


_CLASS_NUMERICS, _CLASS_LABELS = (ROLES.surface, ROLES.ordinal), ("building", "zone", "energy")


def fitted_classes(spark: SparkSession, sf_dir: str) -> tuple[models.FittedModels, DataFrame]:
    """The class-analysis forest on one-hot labels, surface and the grade's ordinal, and its test rows."""

    def fit():
        wanted = [*_CLASS_NUMERICS, *_CLASS_LABELS, TARGET]
        rows = class_rows(spark, sf_dir, *_CLASS_LABELS).select(ROLES.key, *wanted)
        complete = staged(drop_incomplete_rows(rows, wanted), "class-model-rows")
        train, test = sampling.hashed_split(complete, ROLES.key)
        kinds = [models.FOREST]
        return models.train(train, TARGET, _CLASS_LABELS, _CLASS_NUMERICS, kinds, one_hot=True, keys=[ROLES.key]), test

    return _once(_state(spark, sf_dir), "classes", fit)


def _predictions(spark, sf_dir, kind):
    one, test = fitted(spark, sf_dir, (kind,))
    return models.prediction_table(models.score(one.whole(kind), test), TABLE_COLUMNS)


@query("rf_predictions")
def rf_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, models.FOREST)


@query("gbt_predictions")
def gbt_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, models.BOOSTED)


@query("class_predictions")
def class_predictions(spark, sf_dir):
    """The class-analysis model in its four-column form."""
    forest, test = fitted_classes(spark, sf_dir)
    scored = models.score(forest.whole(models.FOREST), forest.ready(test))
    return models.prediction_table(scored, (ROLES.surface, ROLES.ordinal, TARGET))


_CLASS_MODEL = f"""{CLASSED}, class_model as (
  select diag_id, surface, grade_ord, intensity, {IS_TRAIN} as learned from classed
  where building is not null and zone is not null and energy is not null)"""


@query(
    "prediction_keys",
    f"with {_CLASS_MODEL} select surface, grade_ord, intensity, true as in_range from class_model where not learned",
)
def prediction_keys(spark, sf_dir):
    """Every test row is in the four-column table, its score inside the range of the learned targets."""
    forest, _ = fitted_classes(spark, sf_dir)
    rows = class_rows(spark, sf_dir, *_CLASS_LABELS)
    learned = drop_incomplete_rows(rows, _CLASS_LABELS).where(sampling.in_training(ROLES.key))
    low, high = learned.agg(F.min(TARGET), F.max(TARGET)).first()
    inside = F.col("prediction").between(low - 1e-6, high + 1e-6).alias("in_range")
    return class_predictions(spark, sf_dir).select(ROLES.surface, ROLES.ordinal, TARGET, inside)


def scored_by_both(spark, sf_dir):
    both, test = fitted(spark, sf_dir)
    scored = both.prepared(test)
    for name, column in ((models.FOREST, "p_forest"), (models.BOOSTED, "p_boosted")):
        scored = both.models[name].copy({both.models[name].predictionCol: column}).transform(scored)
    return scored


@query("fitted_metrics")
def fitted_metrics(spark, sf_dir):
    """Metrics of both fitted models from one pass over the test rows."""
    names = {models.FOREST: "p_forest", models.BOOSTED: "p_boosted"}
    return models.metrics_by_model(scored_by_both(spark, sf_dir), TARGET, names)


@query(
    "fitted_checks",
    f"""with {STAND_IN}, sizes as (select count(*) as nb from scored)
    select 'RandomForest' as model, nb, true as beats_mean, cast(0 as bigint) as outside_range from sizes
    union all select 'GBT', nb, true, cast(null as bigint) from sizes""",
)
def fitted_checks(spark, sf_dir):
    """Every test row is scored, both models beat the mean, and no forest score leaves the range of the targets."""
    both = scored_by_both(spark, sf_dir)
    rows = model_table(spark, sf_dir, _state(spark, sf_dir))
    low, high = rows.agg(F.min(TARGET), F.max(TARGET)).first()
    outside = F.count_if(~F.col("p_forest").between(low - 1e-6, high + 1e-6))

    def better(column):
        return stats.rmse(F.col(TARGET), F.col(column)) < F.stddev_pop(TARGET)

    wide = both.agg(
        F.count("*").alias("nb"),
        better("p_forest").alias("forest"),
        better("p_boosted").alias("boosted"),
        outside.alias("outside"),
    )

    def row(model, beats, out_of_range):
        return F.struct(
            F.lit(model).alias("model"),
            "nb",
            beats.alias("beats_mean"),
            out_of_range.cast("bigint").alias("outside_range"),
        )

    forest = row(models.FOREST, F.col("forest"), F.col("outside"))
    boosted = row(models.BOOSTED, F.col("boosted"), F.lit(None))
    return wide.select(F.inline(F.array(forest, boosted)))


@query("chosen_model")
def chosen_model(spark, sf_dir):
    return models.best_model(fitted_metrics(spark, sf_dir))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Features of the model that is chosen, by weight."""
    both, test = fitted(spark, sf_dir)
    best = chosen_model(spark, sf_dir).first()["best_model"]
    return models.importance_table(spark, models.feature_importance(both, best, both.prepared(test)))


@query(
    "importance_checks",
    " union all ".join(
        f"select '{c}' as variable, true as in_range, cast(1 as double) as total, {len(NUMERICS) + len(ROLES.categoricals)} as n"
        for c in [*ROLES.categoricals, *NUMERICS]
    ),
)
def importance_checks(spark, sf_dir):
    """The chosen model's importance names every feature once, with shares that add to one and ranks that follow them."""
    found = feature_importance(spark, sf_dir)
    whole = Window.partitionBy().orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    falls = F.lag("importance", 1, 1.0).over(Window.orderBy("rank")) >= F.col("importance")  # one row a feature
    inside = F.col("importance").between(0, 1) & falls
    total = F.round(F.sum("importance").over(whole), 9)
    return found.select("variable", inside.alias("in_range"), total.alias("total"), F.count("*").over(whole).cast("int").alias("n"))


@query(
    "model_saved",
    f"with {STAND_IN} select count(*) as nb, cast(0 as bigint) as differing from scored",
)
def model_saved(spark, sf_dir):
    """A saved and reloaded forest scores every test row as the original does."""
    both, test = fitted(spark, sf_dir, (models.FOREST,))
    path = work_path(spark, "model")
    models.save_model(both.whole(models.FOREST), path)
    again = models.load_model(path)
    scored = models.score(both.models[models.FOREST], both.preparation.transform(test))
    scored = scored.withColumnRenamed("prediction", "first").drop("features", *[f"{c}_idx" for c in ROLES.categoricals])
    compared = models.score(again, scored)
    return compared.agg(
        F.count("*").alias("nb"), F.count_if(F.abs(F.col("first") - F.col("prediction")) > 1e-9).alias("differing")
    )


@query(
    "index_labels",
    f"with {MODEL}, labels as ("
    + " union all ".join(
        f"""select '{c}' as "column", {c} as label, cast(row_number() over (order by count(*) desc, {c}) - 1 as int)
            as idx from model group by {c}"""
        for c in ROLES.categoricals
    )
    + ") select * from labels",
)
def index_labels(spark, sf_dir):
    """Index of every label: by falling frequency, then by name."""
    rows = model_rows(diagnostics(spark, sf_dir), ROLES)
    return label_table(rows, ROLES.categoricals).select("column", "label", "idx")


@query(
    "wide_labels",
    """with labels as (
         select l_orderkey || '-' || l_linenumber || '-' || i as label from lineitem, range(4) as t(i)
         union all select cast(l_orderkey as varchar) from lineitem),
       counts as (select label, count(*) as n from labels group by label)
       select label, n, cast(row_number() over (order by n desc, label) - 1 as double) as label_rank from counts""",
)
def wide_labels(spark, sf_dir):
    """A column of hundreds of thousands of labels, indexed and joined back to its rows."""
    order = F.col("l_orderkey").cast("string")
    several = F.array(*[F.concat_ws("-", order, F.col("l_linenumber"), F.lit(i)) for i in range(4)], order)
    rows = table(spark, sf_dir, "lineitem").select(F.explode(several).alias("label"))
    indexed = with_label_ranks(rows, label_table(rows, ["label"]), ["label"])
    return indexed.groupBy("label", "label_rank").agg(F.count("*").alias("n"))


_INDEXES = "indexes as (" + " union all ".join(
    f"""select '{c}' as col, {c} as label, cast(row_number() over (order by count(*) desc, {c}) - 1 as int) as idx,
               count(*) as n from model group by {c}"""
    for c in ROLES.categoricals
) + ")"


@query("one_hot_slots", f'with {MODEL}, {_INDEXES} select col as "column", label, idx as slot, n from indexes')
def one_hot_slots(spark, sf_dir):
    """The slot that each label fills in its encoded vector, and the rows that fill it and no other."""
    rows = staged(model_rows(diagnostics(spark, sf_dir), ROLES), "one-hot-rows")
    encoded = fit_preparation(rows, ROLES.categoricals, [], one_hot=True).transform(rows)
    cells = []
    for c in ROLES.categoricals:
        slots = vector_to_array(F.col(f"{c}_enc"))
        only = F.when(F.aggregate(slots, F.lit(0.0), lambda a, v: a + v) == 1, F.array_position(slots, F.lit(1.0)) - 1)
        cells.append(F.struct(F.lit(c).alias("column"), F.col(c).alias("label"), only.cast("int").alias("slot")))
    found = encoded.select(F.inline(F.array(*cells)))
    return found.groupBy("column", "label", "slot").agg(F.count("*").alias("n"))


@query(
    "assembled_features",
    f"""with {MODEL}, {_INDEXES}
        select diag_id, {", ".join(f"cast({c}_i.idx as double) as f{i}" for i, c in enumerate(ROLES.categoricals))},
               surface as f{len(ROLES.categoricals)},
               {rounded(COMMUNE_MEAN, 4)} as f{len(ROLES.categoricals) + 1}
        from model {" ".join(f"join indexes {c}_i on {c}_i.col = '{c}' and {c}_i.label = {c}" for c in ROLES.categoricals)}""",
)
def assembled_features(spark, sf_dir):
    """The vector that the models learn from, slot by slot."""
    rows = staged(prepared_rows(spark, sf_dir), "assembled-rows")
    assembled = fit_preparation(rows, ROLES.categoricals, NUMERICS).transform(rows)
    values = vector_to_array(F.col("features"))
    last = len(ROLES.categoricals) + 1
    slots = [half_up(values[i], 4).alias(f"f{i}") if i == last else values[i].alias(f"f{i}") for i in range(last + 1)]
    return assembled.select("diag_id", *slots)


def stand_in(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Test rows with two predictions that SQL can repeat: the train mean of the grade and its published value.

    Both tables have one row per label of the scale, so they are safe to broadcast.
    """
    records = diagnostics(spark, sf_dir, ROLES.key, ROLES.grade, TARGET, *extra)
    rows = model_rows(records, ROLES, carry=("commune_name",))
    train, test = sampling.hashed_split(rows, ROLES.key)
    graded = train.where(GRADES.contains(F.col("grade")))
    means = graded.groupBy("grade").agg(rounded_mean(F.col(TARGET), 4).alias("prediction"))
    constant = F.col("conso").cast("double").alias("prediction_ref")
    published = scenarios.reference_classes(spark).select("grade", constant)
    return test.join(F.broadcast(means), "grade").join(F.broadcast(published), "grade")


@query(
    "stand_in_predictions",
    f"with {STAND_IN} select diag_id, commune, commune_name, grade, building, zone, surface, intensity, prediction "
    "from scored",
)
def stand_in_predictions(spark, sf_dir):
    extra = [c for c in TABLE_COLUMNS if c not in (ROLES.grade, TARGET)]
    return stand_in(spark, sf_dir, *extra).select(ROLES.key, *TABLE_COLUMNS, "prediction")


@query(
    "kpi_predictions",
    f"""with {STAND_IN} select count(*) as nb_logements, {rounded('avg(intensity)', 4)} as conso_moyenne,
        {rounded('sqrt(avg(power(intensity - prediction, 2)))', 4)} as rmse from scored""",
)
def kpi_predictions(spark, sf_dir):
    return stats.prediction_kpis(stand_in(spark, sf_dir), TARGET, "prediction")


@query("axis_bound", f"with {STAND_IN} select greatest(max(intensity), max(prediction)) as max_val from scored")
def axis_bound(spark, sf_dir):
    return stats.axis_bound(stand_in(spark, sf_dir), [TARGET, "prediction"])


def _metrics_sql() -> str:
    rows = []
    for name, column in (("RandomForest", "prediction"), ("GBT", "prediction_ref")):
        rows.append(f"""select '{name}' as model, 'RMSE' as metric,
            {rounded(f'sqrt(avg(power(intensity - {column}, 2)))', 6)} as value from scored""")
        rows.append(f"""select '{name}' as model, 'R2' as metric,
            {rounded(f'1 - sum(power(intensity - {column}, 2)) / (var_pop(intensity) * count(*))', 6)} as value
            from scored""")
    return f"{STAND_IN}, metrics as ({' union all '.join(rows)})"


def stand_in_metrics(spark, sf_dir):
    names = {models.FOREST: "prediction", models.BOOSTED: "prediction_ref"}
    return models.metrics_by_model(stand_in(spark, sf_dir), TARGET, names)


@query("model_metrics", f"with {_metrics_sql()} select * from metrics")
def model_metrics(spark, sf_dir):
    return stand_in_metrics(spark, sf_dir)


@query(
    "best_model",
    f"""with {_metrics_sql()}, wide as (
      select max(case when model = 'GBT' and metric = 'RMSE' then value end) as g_rmse,
             max(case when model = 'GBT' and metric = 'R2' then value end) as g_r2,
             max(case when model = 'RandomForest' and metric = 'RMSE' then value end) as f_rmse,
             max(case when model = 'RandomForest' and metric = 'R2' then value end) as f_r2 from metrics)
    select case when g_rmse < f_rmse then 'GBT' else 'RandomForest' end as best_model,
           case when g_rmse < f_rmse then g_rmse else f_rmse end as rmse,
           case when g_rmse < f_rmse then g_r2 else f_r2 end as r2 from wide""",
)
def best_model(spark, sf_dir):
    return models.best_model(stand_in_metrics(spark, sf_dir))


@query(
    "error_by_grade",
    f"""with {STAND_IN} select grade, count(*) as nb,
        {rounded('sqrt(avg(power(intensity - prediction, 2)))', 4)} as rmse,
        {rounded('max(intensity)', 4)} as max_reel, {rounded('max(prediction)', 4)} as max_predit
        from scored group by grade""",
)
def error_by_grade(spark, sf_dir):
    return models.error_by_group(stand_in(spark, sf_dir), "grade", TARGET, "prediction")


@query(
    "error_sample",
    f"""with {STAND_IN} select diag_id, intensity, prediction from scored
        order by md5(diag_id), diag_id, intensity, prediction limit 800""",
)
def error_sample(spark, sf_dir):
    """Actual beside predicted for 800 rows."""
    return sampling.hashed_sample(stand_in(spark, sf_dir).select("diag_id", TARGET, "prediction"), "diag_id", 800)
