"""Corpus cleaning, lemma lookup and corpus-level risk figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kotomori.config import CLEAN, RISK, CleanSettings, RiskWeights
from kotomori.functions.evasion import with_evasion
from kotomori.functions.text import clean_text
from kotomori.operators.segment import with_segmented_text


def with_processed_text(df: DataFrame, text: str = "text", settings: CleanSettings = CLEAN) -> DataFrame:
    return df.withColumn("processed_text", clean_text(F.col(text), settings))


def clean_corpus(
    df: DataFrame, text: str = "text", settings: CleanSettings = CLEAN, where: Column | str | None = None, dictionary: DataFrame | None = None
) -> DataFrame:
    """Add ``processed_text`` and drop the rows that have nothing left; ``where`` filters the
    input (see :func:`~kotomori.functions.evasion.with_evasion`). A ``dictionary`` of words
    and costs takes the place of the tokenizer of the settings."""
    rows = df if where is None else df.where(where)
    cut = with_processed_text(rows, text, settings) if dictionary is None else with_segmented_text(rows, dictionary, text, settings)
    return cut.where(F.col("processed_text") != "")


def drop_report(df: DataFrame, text: str = "text", settings: CleanSettings = CLEAN) -> DataFrame:
    """How many rows :func:`clean_corpus` keeps and drops, in one pass."""
    empty = F.col("processed_text") == ""
    return with_processed_text(df, text, settings).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(empty).alias("n_dropped"),
        F.count_if(~empty).alias("n_kept"),
    )


def clean_corpus_counted(df: DataFrame, text: str = "text", settings: CleanSettings = CLEAN) -> tuple[DataFrame, Observation]:
    """:func:`clean_corpus` and what :func:`drop_report` counts, known once the frame has been
    written as a whole: ``n_total``, ``n_dropped`` and ``n_kept`` of the observation's ``get``."""
    seen = Observation()
    empty = F.col("processed_text") == ""
    counts = F.count(F.lit(1)).alias("n_total"), F.count_if(empty).alias("n_dropped"), F.count_if(~empty).alias("n_kept")
    return with_processed_text(df, text, settings).observe(seen, *counts).where(~empty), seen


def prepare(
    df: DataFrame,
    text: str = "text",
    settings: CleanSettings = CLEAN,
    weights: RiskWeights = RISK,
    where: Column | str | None = None,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Clean, then analyse evasion; ``processed_text`` ends up normalised.

    ``order="clean_first"`` looks for tricks in the cleaned tokens, which hides
    most of them from a character tokenizer; ``"raw_first"`` looks at the raw
    text and cleans what it has undone. ``where`` filters the input, and a ``dictionary``
    cuts the words (see :func:`clean_corpus`).
    """
    df = df if where is None else df.where(where)
    if settings.order == "clean_first":
        analysed = with_evasion(clean_corpus(df, text, settings, dictionary=dictionary), "processed_text", weights)
        return analysed.drop("processed_text").withColumnRenamed("normalized", "processed_text")
    if settings.order != "raw_first":
        raise ValueError(f"unknown order {settings.order!r}")
    raw = df.withColumn("_raw", F.coalesce(F.col(text), F.lit("")))
    analysed = with_evasion(raw, "_raw", weights).drop("_raw")
    return clean_corpus(analysed, "normalized", settings, dictionary=dictionary).drop("normalized")


def high_risk_rate(df: DataFrame, *by: str, weights: RiskWeights = RISK) -> DataFrame:
    """Rows with a risk above the limit, as count and percent, per ``by``."""
    high = F.count_if(F.col("risk") > weights.high)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        high.alias("n_high"),
        F.round(F.try_divide(high * F.lit(100.0), F.count(F.lit(1))), 2).alias("high_pct"),
    )


def lemmatise(df: DataFrame, lemmas: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """``(key, tokens)`` with tokens replaced by their lemma from ``lemmas(surface,
    lemma)``, order kept; a missing list becomes an empty one.

    The dictionary may be of any size; of several lemmas the first in order counts. Each
    distinct token of a row is looked up once, an inner join that keeps the hits only and
    whose frequent tokens Spark may split. A row then replaces its tokens by itself, from
    the hits of its key.
    """
    rows = df.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("_tokens"))
    known = lemmas.where("surface IS NOT NULL AND lemma IS NOT NULL").groupBy("surface").agg(F.min("lemma").alias("lemma"))
    hits = rows.select(F.col(key).alias("_key"), F.explode(F.array_distinct("_tokens")).alias("surface")).join(known, "surface")
    # rows with one key share their hits: a lemma does not depend on the row
    found = hits.groupBy("_key").agg(F.map_from_entries(F.collect_set(F.struct("surface", "lemma"))).alias("_found"))
    lemma = F.transform("_tokens", lambda t: F.coalesce(F.try_element_at("_found", t), t))
    joined = rows.join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.select(key, F.when(F.col("_found").isNull(), F.col("_tokens")).otherwise(lemma).alias(tokens))
