"""Mixing sources to target weights by Pareto order sampling.

A source with target ``T`` and size ``S`` takes every document ``floor(T / S)`` times
for certain. The rest of the target is drawn without replacement: each document gets a
random number ``u`` from its content and an inclusion probability ``p``, and documents
are taken in the order of

    odds(u) / odds(p)

until the words wanted are reached. As the order is fixed, so is the sample, and its
size is fixed in words rather than left to chance. ``odds(p)`` is the source's common
odds times the document's weight.

The order is never made for a whole source. A histogram over equal parts of the order
finds the part where the target is reached; earlier parts are taken whole, and only that
part is sorted. Then a few documents are drawn or given back, each the one that brings
the source nearest to its target; of equal ones the first in the order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kotomori.llm.common import register, table
from kotomori.session import pin

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSettings:
    #: Weights of the sources in their order, repeating.
    weights: tuple[int, ...] = (3, 1, 2)
    #: Words of the mix, as a share of all words.
    share: float = 1.5
    #: The most a document or a source is repeated.
    most: int = 2
    #: Parts of the order that are summed before one of them is sorted.
    parts: int = 1024
    #: Bounds of a document's weight.
    least_weight: float = 1 / 16
    most_weight: float = 16.0
    #: Documents of a source that are drawn or given back, one after the other, to come nearer to the target.
    closing: int = 3
    seed: int = 6


def source_targets(sizes: DataFrame, settings: MixSettings) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, a row per source.

    Shares by weight are cut at ``most`` times a source's size, and the excess is shared
    again. Sorted by how soon a source is cut, the sources before the first uncut one are
    the cut ones, so running sums settle all rounds at once. The two windows see one row
    per source label, no documents.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    ranked = sizes.withColumn("w", F.get(weights, (F.row_number().over(every) - 1) % len(settings.weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(settings.most))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * settings.share
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level).withColumn("cut", F.col("cap") <= F.col("w") * F.col("level"))
    first = F.min(F.when(~F.col("cut"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)
    return levels.withColumn("level", first["level"]).select(
        "source", "source_size", F.when(F.col("cut"), F.col("cap")).otherwise(F.col("w") * F.col("level")).alias("target")
    )


def odds(x: Column) -> Column:
    return x / (F.lit(1.0) - x)


def mix(docs: DataFrame, settings: MixSettings, key: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None, drawn_by: tuple[str, ...] = ()) -> DataFrame:
    """``(key, source, size, source_size, target, copies, taken)``, a row for each row.

    ``weight``: relative inclusion odds of a document, over the columns of ``docs``; null
    counts as 1. The random numbers come from the columns ``drawn_by``, key and text unless
    given. A null or empty text has size 0 and takes part in whole copies only. A
    null source is a source of its own, the last. Repeated rows are drawn one by one;
    which of equal rows is drawn is of no account. Without words all targets are 0.
    """
    relative = F.lit(1.0) if weight is None else F.greatest(F.lit(settings.least_weight), F.least(F.lit(settings.most_weight), F.coalesce(weight.cast("double"), F.lit(1.0))))
    drawn = F.xxhash64(F.lit(settings.seed), *[F.col(f"`{c}`") for c in drawn_by or (key, text)])
    u = (F.shiftrightunsigned(drawn, 11) + 0.5) / float(1 << 53)
    ratio = odds(u) / relative
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{source}`").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ratio.alias("ratio"),
    ).withColumn("part", F.floor(F.col("ratio") / (F.col("ratio") + 1) * settings.parts).cast("int"))
    rows = pin(sized, "mix-rows")  # rows keep their number from here on
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(settings.most))).otherwise(0).cast("int")
    targets = pin(source_targets(sizes, settings).withColumn("whole", whole).withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    of = F.col("source").eqNullSafe(F.col("of"))  # sources may be null

    # The part of each source's order in which the wanted words are reached.
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    wanted = targets.select(F.col("source").alias("of"), "wanted")
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("part"))
    crossing = parts.join(wanted, of).withColumn("upto", upto).where(F.col("upto") > F.col("wanted"))
    crossing = crossing.groupBy("of").agg(F.min(F.struct("part", (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
    plan = targets.join(crossing, of, "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole", "wanted",
        F.coalesce("c.part", F.lit(settings.parts)).alias("last_part"), F.coalesce("c.before", F.lit(0)).alias("before"),
    )
    placed = rows.join(pin(plan, "mix-plan"), of).drop("of")
    # Only the rows of that part are sorted.
    order = Window.partitionBy("source", "part").orderBy("ratio", "row").rowsBetween(Window.unboundedPreceding, 0)
    last = placed.where(F.col("part") == F.col("last_part")).withColumn("upto", F.col("before") + F.sum("size").over(order))
    inside = last.where(F.col("upto") <= F.col("wanted")).select("row", F.lit(True).alias("inside"))
    extra = (F.col("size") > 0) & ((F.col("part") < F.col("last_part")) | F.coalesce("inside", F.lit(False)))
    drawn = pin(placed.join(inside, "row", "left").withColumn("extra", extra).drop("part", "last_part", "before", "inside"), "mix-drawn")

    for _ in range(settings.closing):
        taken = F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0))
        short = drawn.groupBy(F.col("source").alias("of")).agg((F.first("wanted") - taken).alias("short")).where("abs(short) >= 1")
        change = F.when(F.col("extra"), -F.col("size")).otherwise(F.col("size"))
        off = F.abs(F.col("short") - change)
        fit = drawn.join(short, of).where((off < F.abs("short")) & (F.col("whole") < settings.most))
        fit = fit.groupBy("of").agg(F.min(F.struct(off.alias("off"), "ratio", "row"))["row"].alias("row"))
        drawn = drawn.join(fit.select("row", F.lit(True).alias("turns")), "row", "left").withColumn("extra", F.col("extra") != F.coalesce("turns", F.lit(False))).drop("turns")

    copies = F.col("whole") + F.col("extra").cast("int")
    return drawn.select(
        F.col("key").alias(key), "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def longer_first(text: str = "text") -> Column:
    """Weight of a document by its length: mildly in favour of longer ones."""
    return F.log2(F.length(text) + 2.0) / 8


@register("op6_mixing")
def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"), MixSettings(), weight=longer_first()).drop("source", "copies")
