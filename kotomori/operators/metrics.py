"""Evaluation. One group-by of (truth, prediction) feeds everything but the
row-level error tables, so a metric never costs more than one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kotomori.config import LABELS, SEVERITY_WEIGHTS
from kotomori.operators.labels import decode

CLASS_IDS = tuple(range(len(LABELS)))


def confusion_counts(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """``(y_true, y_pred, n)`` for every pair of classes, absent pairs as zero.

    Every row counts: a class that is NULL or unknown on either side is an error when
    the counts are read. :func:`outside` gives those rows, to set them aside. Conditional counts in a single row, then one row per cell: the label domain is
    closed, so the matrix needs no join against it.
    """
    cells = [(t, p) for t in CLASS_IDS for p in CLASS_IDS]
    counts = [
        F.count_if((F.col(y_true) == t) & (F.col(y_pred) == p)).alias(f"c{t}{p}") for t, p in cells
    ]
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.col(f"c{t}{p}").alias("n"))
            for t, p in cells
        ]
    )
    unknown = F.count_if(_outside(y_true, y_pred)).alias("outside")
    said = F.concat(F.col("outside").cast("string"), F.lit(f" rows with a class of {y_true} or {y_pred} outside {CLASS_IDS}"))
    checked = F.when(F.col("outside") == 0, rows).otherwise(F.raise_error(said))
    return scored.agg(*counts, unknown).select(F.inline(checked))


def _outside(y_true: str, y_pred: str) -> Column:
    return ~F.coalesce(F.col(y_true).isin(*CLASS_IDS) & F.col(y_pred).isin(*CLASS_IDS), F.lit(False))


def outside(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Rows with a class that is NULL or unknown, which no metric can count."""
    return scored.where(_outside(y_true, y_pred))


def confusion_normalised(confusion: DataFrame) -> DataFrame:
    """Share of each truth row; NULL for a class without rows."""
    support = F.sum("n").over(Window.partitionBy("y_true"))
    return confusion.select("y_true", "y_pred", "n", F.try_divide("n", support).alias("share"))


def _by_class(confusion: DataFrame) -> DataFrame:
    """``(class, support, precision, recall, f1)``, undefined ratios as zero."""
    def side(class_id: Column, hit: Column, truth: Column, guess: Column) -> Column:
        return F.struct(class_id.alias("class_id"), hit.alias("hit"), truth.alias("truth"), guess.alias("guess"))

    none, n = F.lit(0).cast("long"), F.col("n")
    hit = F.when(F.col("y_true") == F.col("y_pred"), n).otherwise(none)
    sides = confusion.select(
        F.inline(F.array(side(F.col("y_true"), hit, n, none), side(F.col("y_pred"), none, none, n)))
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    sums = sides.groupBy("class_id").agg(F.sum("hit").alias("hit"), F.sum("truth").alias("support"), F.sum("guess").alias("guess"))
    return sums.select(
        "class_id",
        "hit",
        "support",
        ratio(F.col("hit"), F.col("guess")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(F.lit(2.0) * F.col("hit"), F.col("guess") + F.col("support")).alias("f1"),
    )


def class_report(confusion: DataFrame) -> DataFrame:
    """``(name, precision, recall, f1, support)``: classes, accuracy, averages."""
    per_class = _by_class(confusion)
    measures = ("precision", "recall", "f1")
    weighted = [
        F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")), F.lit(0.0)).alias(m)
        for m in measures
    ]
    accuracy = F.coalesce(F.try_divide(F.sum("hit"), F.sum("support")), F.lit(0.0))
    total = F.sum("support").alias("support")
    return (
        per_class.select(decode(F.col("class_id")).alias("name"), *measures, "support")
        .unionByName(
            per_class.agg(*[accuracy.alias(m) for m in measures], total).withColumn("name", F.lit("accuracy"))
        )
        .unionByName(
            per_class.agg(*[F.avg(m).alias(m) for m in measures], total).withColumn("name", F.lit("macro avg"))
        )
        .unionByName(per_class.agg(*weighted, total).withColumn("name", F.lit("weighted avg")))
    )


def f1_scores(confusion: DataFrame) -> DataFrame:
    """One row ``(f1_macro, f1_weighted, accuracy)``."""
    return _by_class(confusion).agg(
        F.avg("f1").alias("f1_macro"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")), F.lit(0.0)).alias("f1_weighted"),
        F.coalesce(F.try_divide(F.sum("hit"), F.sum("support")), F.lit(0.0)).alias("accuracy"),
    )


def severity_weighted_accuracy(confusion: DataFrame, weights: tuple[float, ...] = SEVERITY_WEIGHTS) -> DataFrame:
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("y_true")) * F.col("n")
    hit = F.when(F.col("y_true") == F.col("y_pred"), weight).otherwise(F.lit(0.0))
    return confusion.agg(F.try_divide(F.sum(hit), F.sum(weight)).alias("severity_weighted_accuracy"))


def evaluation_summary(confusion: DataFrame) -> DataFrame:
    """The scalar metrics in one row, from nine input rows."""
    return f1_scores(confusion).select(
        "*", severity_weighted_accuracy(confusion).scalar().alias("severity_weighted_accuracy")
    )


def error_rows(scored: DataFrame, key: str, text: str = "text", y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    return scored.where(F.col(y_true) != F.col(y_pred)).select(
        key,
        text,
        decode(F.col(y_true)).alias("true_label"),
        decode(F.col(y_pred)).alias("predicted_label"),
    )


def error_rate(confusion: DataFrame) -> DataFrame:
    wrong = F.sum(F.when(F.col("y_true") != F.col("y_pred"), F.col("n")).otherwise(0))
    return confusion.agg(
        wrong.alias("n_errors"),
        F.sum("n").alias("n_total"),
        F.round(F.try_divide(wrong * F.lit(100.0), F.sum("n")), 1).alias("error_pct"),
    )


def error_sample(errors: DataFrame, key: str, n: int = 10, seed: int = 42, text: str = "text") -> DataFrame:
    """``n`` errors in hash order, so a repeated run shows the same ones."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    picked = errors.withColumn("_order", order).orderBy("_order", key).limit(n)
    return picked.select(
        key,
        F.concat(F.substring(text, 1, 80), F.lit("...")).alias("text_preview"),
        "true_label",
        "predicted_label",
    )


def run_summary(prepared: DataFrame, split: DataFrame, confusion: DataFrame, high: float) -> DataFrame:
    """One row: split sizes, rounded metrics, share of high-risk rows."""
    metrics = evaluation_summary(confusion)
    sizes = split.agg(F.count_if(~F.col("is_test")).alias("train"), F.count_if("is_test").alias("test"))
    risky = prepared.agg(
        F.round(F.try_divide(F.count_if(F.col("risk") > high) * F.lit(100.0), F.count(F.lit(1))), 2)
    )
    return metrics.select(
        sizes.select("train").scalar().alias("train_samples"),
        sizes.select("test").scalar().alias("test_samples"),
        F.round("f1_macro", 4).alias("f1_macro"),
        F.round("f1_weighted", 4).alias("f1_weighted"),
        F.round("severity_weighted_accuracy", 4).alias("severity_weighted_accuracy"),
        risky.scalar().alias("high_adversarial_risk_pct"),
    )
