"""Class names and ids, and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kotomori.config import LABELS


def encode(name: Column) -> Column:
    """Class id of a name; NULL for names outside the domain."""
    pairs = [x for i, label in enumerate(LABELS) for x in (F.lit(label), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), name)


def decode(class_id: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in LABELS]), class_id.cast("int"))


def encode_labels(df: DataFrame, label: str = "label", out: str = "label_id") -> DataFrame:
    """Rows of known classes with their id; the rest is in :func:`unknown_labels`."""
    return df.withColumn(out, encode(F.col(label))).where(F.col(out).isNotNull())


def unknown_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(encode(F.col(label)).isNull())


def class_weights(df: DataFrame, label: str = "label_id") -> DataFrame:
    """``(label, n, weight)`` with weight n / (classes * n of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy()  # over one row per class
    weight = F.sum("n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n"))
    return counts.withColumn("weight", weight)


def with_class_weight(df: DataFrame, label: str = "label_id", out: str = "class_weight") -> DataFrame:
    """Add the balanced weight of each row's class.

    The weights have a row per class; Spark broadcasts them if that is small.
    """
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(weights, label)
