"""Scoring: from raw rows to prediction records, one lazy plan without a shuffle."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotomori.config import CLEAN, CleanSettings
from kotomori.functions.evasion import flags_map, row_flags
from kotomori.functions.text import preview
from kotomori.operators.classify import predict
from kotomori.operators.cleaning import prepare
from kotomori.operators.features import TfidfModel
from kotomori.operators.triage import confidence, escalate_simple, tier_simple


def score_rows(df: DataFrame, model: PipelineModel, features: TfidfModel, text: str = "text", clean: CleanSettings = CLEAN, where: Column | str | None = None) -> DataFrame:
    """Everything known about a row: signals, risk, class, confidence, tier. ``where`` filters
    the input, ahead of all text functions."""
    prepared = prepare(df, text, clean, where=where)
    scored = predict(model, features.transform(prepared)).drop("features")
    return (
        scored.withColumn("confidence", confidence(F.col("probabilities"), F.col("y_pred")))
        .withColumn("severity_tier", tier_simple(F.col("predicted_class"), F.col("risk")))
        .withColumn("escalate_to_human", escalate_simple(F.col("severity_tier")))
    )


def prediction_records(scored: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The output record of a scored row, under the key it came with."""
    return scored.select(
        key,
        preview(F.col(text)).alias("text_preview"),
        "predicted_class",
        "confidence",
        "severity_tier",
        "escalate_to_human",
        F.round("risk", 3).alias("adversarial_risk_score"),
        flags_map().alias("adversarial_flags"),
    )


def documented_records(scored: DataFrame, text: str = "text") -> DataFrame:
    """The richer record with its nested taxonomy, named as the taxonomy names it, or by the
    class where no phrase was found; ``scored`` has been through ``with_taxonomy``."""
    return scored.select(
        text,
        "predicted_class",
        "confidence",
        "severity_tier",
        "escalate_to_human",
        F.struct(F.coalesce("subcategory_name", "category").alias("category"), "subcategory", row_flags().alias("flags")).alias("taxonomy"),
    )


def score_corpus(df: DataFrame, key: str, model: PipelineModel, features: TfidfModel, text: str = "text", clean: CleanSettings = CLEAN, where: Column | str | None = None) -> DataFrame:
    return prediction_records(score_rows(df, model, features, text, clean, where), key, text)
