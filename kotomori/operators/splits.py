"""Exact stratified splits without ranking a whole class in one task.

Rows are ordered inside their class by ``md5(seed|key)``. A class may hold most of
the data, so instead of ``row_number`` over a class, a histogram of hash prefixes
finds the bucket in which each wanted rank lies, and only that bucket is ranked.

``label`` is a closed domain of classes (encode and set aside the rest first); the
tables that are broadcast here have a row per class, or per class and wanted rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kotomori.session import pin

PREFIX = 4  # hex digits: 65,536 buckets per class


def split_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))


def rank_cutoffs(df: DataFrame, label: str, key: str, seed: int, ranks) -> DataFrame:
    """``(label, cuts)``: the ``(hash, key)`` found at each wanted rank of a class.

    ``ranks`` maps a Column with the class size to an array of wanted ranks (one
    based; rank 0 asks for nothing). A rank wanted twice is one cut with ``times``
    2. The result has one row per class.
    """
    hashed = df.select(F.col(label), F.col(key).alias("k"), split_hash(key, seed).alias("h"))
    hashed = hashed.withColumn("bucket", F.substring("h", 1, PREFIX))
    whole = Window.partitionBy(label)
    buckets = (
        hashed.groupBy(label, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("class_n", F.sum("n").over(whole))
        .withColumn("upto", F.sum("n").over(whole.orderBy("bucket")))
        .withColumn("rank", F.explode(ranks(F.col("class_n"))))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .groupBy(label, "bucket")
        .agg(F.collect_list(F.col("rank") - (F.col("upto") - F.col("n"))).alias("wanted"))
    )
    # one row per class and wanted rank, so the scan side stays where it is
    inside = hashed.join(F.broadcast(buckets), [label, "bucket"])
    place = F.row_number().over(Window.partitionBy(label, "bucket").orderBy("h", "k"))
    return (
        inside.withColumn("place", place.cast("long"))
        .where(F.array_contains("wanted", F.col("place")))
        .withColumn("times", F.size(F.filter("wanted", lambda w: w == F.col("place"))))
        .groupBy(label)
        .agg(F.collect_list(F.struct(F.struct("h", "k").alias("at"), "times")).alias("cuts"))
    )


def _with_cuts(df: DataFrame, label: str, key: str, seed: int, ranks, eager: bool) -> DataFrame:
    cuts = rank_cutoffs(df, label, key, seed, ranks)
    if eager:
        cuts = pin(cuts, "cuts")
    return df.join(F.broadcast(cuts), label, "left").withColumn(
        "_at", F.struct(split_hash(key, seed).alias("h"), F.col(key).alias("k"))
    )


def _cuts_ahead() -> Column:
    """How many wanted ranks lie at or behind the row; 0 where a class has no cut."""
    return F.coalesce(
        F.aggregate(
            "cuts",
            F.lit(0),
            lambda total, cut: total + F.when(F.col("_at") <= cut["at"], cut["times"]).otherwise(0),
        ),
        F.lit(0),
    )


def stratified_split(df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42, eager: bool = False) -> DataFrame:
    """Add ``is_test``: per class exactly ``round(fraction * n)`` rows.

    ``eager`` finds the cuts now and stores them, a row per class, so that a frame
    read many times afterwards only compares hashes.
    """

    def ranks(n: Column) -> Column:
        return F.array(F.round(n * F.lit(fraction)).cast("long"))

    return (
        _with_cuts(df, label, key, seed, ranks, eager)
        .withColumn("is_test", _cuts_ahead() > 0)
        .drop("_at", "cuts")
    )


def kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, eager: bool = False) -> DataFrame:
    """Add ``fold`` in 0..k-1: per class, fold sizes differ by at most one row."""

    def ranks(n: Column) -> Column:
        return F.array(*[F.floor(n * F.lit(i) / F.lit(k)).cast("long") for i in range(1, k)])

    return (
        _with_cuts(df, label, key, seed, ranks, eager)
        .withColumn("fold", F.lit(k - 1) - _cuts_ahead())
        .drop("_at", "cuts")
    )
