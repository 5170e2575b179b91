"""Training: clean, split, fit features, cross-validate, fit, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotomori.config import CLEAN, FEATURES, FOREST, RISK, CleanSettings, FeatureSettings, ForestSettings
from kotomori.operators import classify, metrics
from kotomori.operators.cleaning import prepare
from kotomori.operators.features import TfidfModel
from kotomori.operators.labels import encode_labels, unknown_labels
from kotomori.operators.splits import stratified_split
from kotomori.session import pin
from kotomori.sources.corpus import require_columns
from kotomori.sources.sinks import sink_errors_csv, sink_summary


@dataclass
class TrainingRun:
    unknown: DataFrame  # rows whose label is no class; no other part of the run has them
    features: TfidfModel
    vectors: DataFrame  # key, row, label_id, is_test and features of the rows of both parts
    model: PipelineModel
    cross_validation: DataFrame | None
    predictions: DataFrame
    confusion: DataFrame
    report: DataFrame
    errors: DataFrame
    summary: DataFrame


def prepared_split(df: DataFrame, key: str, text: str, label: str, clean: CleanSettings = CLEAN) -> DataFrame:
    """Cleaned, encoded and split rows; every later step reads the pinned table."""
    labelled = encode_labels(require_columns(df, key, text, label), label)
    columns = (key, text, "label_id", "processed_text", "risk", F.monotonically_increasing_id().alias("row"))
    rows = pin(prepare(labelled, text, clean).select(*columns), "prepared")  # rows keep their number from here on
    return stratified_split(rows, "label_id", key, eager=True)


def train(
    df: DataFrame,
    key: str = "id",
    text: str = "text",
    label: str = "label",
    tune: bool = False,
    folds: int = 5,
    output: str | None = None,
    clean: CleanSettings = CLEAN,
    settings: FeatureSettings = FEATURES,
    forest: ForestSettings = FOREST,
    refit_per_fold: bool = False,
) -> TrainingRun:
    """The whole flow; ``output`` is the folder that takes models and reports.

    Folds share the vocabulary of the training part unless ``refit_per_fold``.
    ``folds=0`` skips cross-validation. Rows with a label that is no class take no part;
    they are the run's ``unknown`` and go to ``unknown_labels`` below ``output``.
    """
    rows = prepared_split(df, key, text, label, clean)
    train_rows = rows.where(~F.col("is_test"))
    features = TfidfModel.fit(train_rows, "processed_text", settings)
    vectors = pin(features.transform(rows).select(key, "row", "label_id", "is_test", "features"), "features")
    train_vectors = vectors.where(~F.col("is_test"))

    cross_validation = None
    if folds and refit_per_fold:
        cross_validation = classify.cross_validate_refit(train_rows, key, settings, forest, folds)
    elif folds:
        cross_validation = classify.cross_validate(
            train_vectors, key, lambda _: classify.random_forest(forest), folds, partitions=forest.partitions
        )

    model = classify.train_model(train_vectors, key, tune, f"{output}/classifier" if output else None, forest)
    scored = classify.predict(model, vectors.where("is_test")).withColumnRenamed("label_id", "y_true")
    scores = pin(scored.drop("features"), "predictions")
    predictions = rows.where("is_test").drop("label_id", "is_test", key).join(scores, "row").drop("row")
    confusion = metrics.confusion_counts(scores)
    run = TrainingRun(
        unknown=unknown_labels(df, label),
        features=features,
        vectors=vectors,
        model=model,
        cross_validation=cross_validation,
        predictions=predictions,
        confusion=confusion,
        report=metrics.class_report(confusion),
        errors=metrics.error_rows(predictions, key, text),
        summary=metrics.run_summary(rows, rows, confusion, RISK.high),
    )
    if output:
        features.save(f"{output}/vocabulary")
        sink_errors_csv(run.unknown.select(key, text, label), f"{output}/unknown_labels", mode="overwrite")
        sink_errors_csv(run.errors, f"{output}/error_analysis", mode="overwrite")
        sink_summary(run.summary, f"{output}/summary", mode="overwrite")
    return run
