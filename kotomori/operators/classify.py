"""Classifiers, cross-validation and grid search on Spark ML.

All functions take a frame with ``features``, ``label_id`` and a key column.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.config import FEATURES, FOREST, FeatureSettings, ForestSettings
from kotomori.operators.features import TfidfModel
from kotomori.operators.forest import Forest, ForestModel
from kotomori.operators.labels import decode, with_class_weight
from kotomori.operators.metrics import confusion_counts, f1_scores
from kotomori.operators.splits import kfold

TUNING_GRID = {"trees": (100, 200), "max_depth": (30, 20), "min_instances": (1, 2)}


def training_frame(df: DataFrame, key: str, partitions: int = FOREST.partitions) -> DataFrame:
    """Balanced class weights, and rows in an order that does not depend on how they
    arrived, for trees sample within partitions."""
    weighted = with_class_weight(df).withColumn("label", F.col("label_id").cast("double"))
    return weighted.repartitionByRange(partitions, key).sortWithinPartitions(key)


def fit(estimator: Estimator, train: DataFrame) -> PipelineModel:
    """Fit on a frame held for the passes a fit makes, and let go of it."""
    held = train.persist()
    try:
        return estimator.fit(held)
    finally:
        held.unpersist()


def _forest(settings: ForestSettings, features: str) -> Forest:
    return Forest(
        RandomForestClassifier(
            featuresCol=features,
            labelCol="label",
            weightCol="class_weight",
            numTrees=settings.trees,
            maxDepth=settings.max_depth,
            minInstancesPerNode=settings.min_instances,
            featureSubsetStrategy="sqrt",
            seed=settings.seed,
        )
    )


def random_forest(settings: ForestSettings = FOREST) -> Pipeline:
    """Balanced random forest, behind the feature selection of the settings."""
    if settings.select_top is None:
        return Pipeline(stages=[_forest(settings, "features")])
    selector = UnivariateFeatureSelector(
        featuresCol="features", labelCol="label", outputCol="selected", selectionMode="numTopFeatures"
    )
    selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(settings.select_top)
    return Pipeline(stages=[selector, _forest(settings, "selected")])


def logistic_baseline(n_rows: int, c: float = 1.0, max_iter: int = 1000) -> Pipeline:
    """Multinomial regression with inverse penalty ``c``.

    Balanced weights add up to the number of rows, which turns the penalty of the
    summed loss into the one of Spark's mean loss.
    """
    return Pipeline(
        stages=[
            LogisticRegression(
                labelCol="label",
                weightCol="class_weight",
                family="multinomial",
                regParam=1.0 / (c * n_rows),
                elasticNetParam=0.0,
                maxIter=max_iter,
                tol=1e-4,
                standardization=False,
            )
        ]
    )


def predict(model, df: DataFrame) -> DataFrame:
    """Add ``y_pred``, ``predicted_class`` and the array ``probabilities``."""
    scored = model.transform(df)
    extra = [c for c in ("rawPrediction", "probability", "prediction", "selected") if c in scored.columns]
    return scored.withColumns(
        {
            "y_pred": F.col("prediction").cast("int"),
            "predicted_class": decode(F.col("prediction")),
            "probabilities": vector_to_array("probability"),
        }
    ).drop(*extra)


def fold_metrics(scored: DataFrame) -> DataFrame:
    return f1_scores(confusion_counts(scored, "label_id", "y_pred"))


def cross_validate(
    df: DataFrame,
    key: str,
    estimator: Callable[[DataFrame], Estimator],
    k: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    partitions: int = FOREST.partitions,
) -> DataFrame:
    """``(fold, f1_macro, f1_weighted, accuracy)``, one row per stratified fold."""
    folds = kfold(df, "label_id", key, k, seed, eager=True)

    def one(fold: int) -> DataFrame:
        train = training_frame(folds.where(F.col("fold") != fold).drop("fold"), key, partitions)
        model = fit(estimator(train), train)
        return fold_metrics(predict(model, folds.where(F.col("fold") == fold))).select(F.lit(fold).alias("fold"), "*")

    with ThreadPool(parallelism) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, range(k)))


def cross_validate_refit(
    df: DataFrame,
    key: str,
    text_settings: FeatureSettings = FEATURES,
    forest: ForestSettings = FOREST,
    k: int = 5,
    text: str = "processed_text",
) -> DataFrame:
    """As :func:`cross_validate`, with the vocabulary fitted anew inside each fold."""
    folds = kfold(df, "label_id", key, k, forest.seed, eager=True)

    def one(fold: int) -> DataFrame:
        train = folds.where(F.col("fold") != fold).drop("fold")
        features = TfidfModel.fit(train, text, text_settings)
        model = fit(random_forest(forest), training_frame(features.transform(train, text), key, forest.partitions))
        held_out = features.transform(folds.where(F.col("fold") == fold), text)
        return fold_metrics(predict(model, held_out)).select(F.lit(fold).alias("fold"), "*")

    return reduce(DataFrame.unionByName, [one(i) for i in range(k)])


def cross_validation_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric."""
    names = ("f1_macro", "f1_weighted", "accuracy")
    return per_fold.agg(
        *[f(n).alias(f"{n}_{s}") for n in names for s, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )


@dataclass
class GridSearch:
    candidates: list[ForestSettings]
    f1_macro: list[float]
    bestModel: PipelineModel

    @property
    def best(self) -> int:
        """The first candidate with the best mean macro F1."""
        return self.f1_macro.index(max(self.f1_macro))


def depth_binds(model: PipelineModel, max_depth: int) -> bool:
    """Could the forest have come out otherwise with this limit? Not if all its trees ended
    above it by themselves."""
    return max(tree.depth for tree in model.stages[-1].trees) >= max_depth


def fit_depths(some: list[ForestSettings], train: DataFrame) -> list[PipelineModel]:
    """The forests of settings that differ in depth alone, grown once; equal ones are one model."""
    *ahead, forest = random_forest(some[0]).getStages()
    before = Pipeline(stages=ahead).fit(train)
    models: dict[int, PipelineModel] = {}
    return [models.setdefault(id(m), PipelineModel([*before.stages, m])) for m in forest.fit_depths(before.transform(train), [c.max_depth for c in some])]


def grid_search(
    df: DataFrame,
    key: str,
    settings: ForestSettings = replace(FOREST, min_instances=1),
    grid: dict[str, Iterable] = TUNING_GRID,
    k: int = 3,
    parallelism: int = 8,
) -> GridSearch:
    """Forest grid on stratified folds, best macro F1 refitted on all rows.

    Class weights are those of the rows a forest is fitted on, so each fold has its own.
    Candidates that differ in depth alone come from one forest, grown with the deepest limit and
    cut at the others; one whose limit no tree reached is that forest and takes its result. All
    folds and candidates are fitted side by side.
    """
    candidates = [replace(settings, **dict(zip(grid, values))) for values in product(*grid.values())]
    folds = kfold(df, "label_id", key, k, settings.seed, eager=True)
    alike: dict[ForestSettings, list[ForestSettings]] = {}
    for c in candidates:
        alike.setdefault(replace(c, max_depth=0), []).append(c)
    trains = [training_frame(folds.where(F.col("fold") != fold).drop("fold"), key, settings.partitions).persist() for fold in range(k)]

    def family(job: tuple[int, list[ForestSettings]]) -> dict[ForestSettings, float]:
        fold, some = job
        held_out, found, f1 = folds.where(F.col("fold") == fold), {}, {}
        for c, model in zip(some, fit_depths(some, trains[fold])):
            if id(model) not in f1:
                f1[id(model)] = fold_metrics(predict(model, held_out)).first()["f1_macro"]
            found[c] = f1[id(model)]
        return found

    jobs = [(fold, some) for fold in range(k) for some in alike.values()]
    with ThreadPool(parallelism) as pool:
        found = pool.map(family, jobs, chunksize=1)
    for train in trains:
        train.unpersist()
    totals = [sum(f1[c] for f1 in found if c in f1) / k for c in candidates]
    best = candidates[totals.index(max(totals))]
    model = fit(random_forest(best), training_frame(df, key, settings.partitions))
    return GridSearch(candidates, totals, model)


def grid_results(search: GridSearch, df: DataFrame) -> DataFrame:
    """``(trees, max_depth, min_instances, f1_macro, best)`` of a finished search."""
    rows = [(c.trees, c.max_depth, c.min_instances, f1, i == search.best) for i, (c, f1) in enumerate(zip(search.candidates, search.f1_macro))]
    return df.sparkSession.createDataFrame(rows, "trees int, max_depth int, min_instances int, f1_macro double, best boolean")


def train_model(df: DataFrame, key: str, tune: bool = False, path: str | None = None, settings: ForestSettings = FOREST) -> PipelineModel:
    """Fit the forest, or the best of the grid, and save it if asked."""
    if tune:
        model = grid_search(df, key, replace(settings, min_instances=1)).bestModel
    else:
        model = fit(random_forest(settings), training_frame(df, key, settings.partitions))
    if path:
        save_model(model, path)
    return model


def save_model(model: PipelineModel, path: str) -> None:
    """Write the model in Spark's format. A forest's nodes are copied from the table they are in, and
    not through the driver."""
    if not any(isinstance(stage, ForestModel) for stage in model.stages):
        return model.write().overwrite().save(path)
    spark = SparkSession.active()
    PipelineModel([]).write().overwrite().save(path)
    for stage, to in zip(model.stages, _stage_paths(path, [stage.uid for stage in model.stages])):
        if isinstance(stage, ForestModel):
            for table in ("data", "treesMetadata"):
                spark.read.parquet(f"{stage.path}/{table}").write.parquet(f"{to}/{table}")
            spark.read.text(f"{stage.path}/metadata").coalesce(1).write.text(f"{to}/metadata")
        else:
            stage.write().save(to)
    about = json.loads(spark.read.text(f"{path}/metadata").first().value)
    about |= {"uid": model.uid, "paramMap": {"stageUids": [stage.uid for stage in model.stages]}}
    spark.range(1).select(F.lit(json.dumps(about)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def _stage_paths(path: str, uids: list[str]) -> list[str]:
    """Where Spark has the stages of a saved pipeline."""
    return [f"{path}/stages/{i:0{len(str(len(uids)))}d}_{uid}" for i, uid in enumerate(uids)]


def load_model(path: str) -> PipelineModel:
    """A saved model; a forest stays where it is until it is asked for (see :class:`ForestModel`)."""
    spark = SparkSession.active()
    about = json.loads(spark.read.text(f"{path}/metadata").first().value)
    stages = []
    for at in _stage_paths(path, about["paramMap"].get("stageUids", [])):
        kind = json.loads(spark.read.text(f"{at}/metadata").first().value)["class"]
        stages.append(ForestModel.read(at) if kind.endswith(".RandomForestClassificationModel") else DefaultParamsReader.loadParamsInstance(at, spark))
    model = PipelineModel(stages)
    return model._resetUid(about["uid"])
