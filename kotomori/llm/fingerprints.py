"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is read as pieces. A piece ends behind a closing character, before white space or at
the end of the text; closing are the ASCII characters whose code divides by ``stride`` and
all others beyond ASCII. So a character closes by itself and not by its place in a run, and
text without spaces falls into step again behind the next closing character, however much
was put in before it. Of the stretches of ``k`` pieces those are kept whose smallest inner
stretch of ``s`` pieces, by hash, is the first or the last one. Whether a stretch is kept
depends on its own characters and on where its first piece begins, so equal passages give
equal anchors wherever they stand, and anchors with their places align two texts.

Two texts are matched in place: an anchor, the next one and the number of pieces between
them are a link, and the likeness of two texts is the share of links they have in common.
All anchors take part, however long a text is. The fingerprint as a string is shorter: the
``kept`` smallest hashes of the anchors and a digest of all anchors and places.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kotomori.llm.common import register, table, texts


@dataclass(frozen=True)
class SyncmerSettings:
    #: One of so many ASCII characters closes a piece.
    stride: int = 5
    k: int = 5
    s: int = 2
    #: Anchor hashes in a fingerprint's string.
    kept: int = 64
    #: Key ranges found by percentiles, before they are split evenly.
    ranges: int = 64


def piece_pattern(stride: int) -> str:
    """Characters that do not close and the one that does, or such characters alone."""
    visible = [c for c in range(128) if c != 0x20 and not 0x09 <= c <= 0x0D]
    opens = "".join(rf"\x{c:02x}" for c in visible if c % stride)
    closes = "".join(rf"\x{c:02x}" for c in visible if c % stride == 0) + r"\x{80}-\x{10ffff}"
    return f"[{opens}]*+[{closes}]|[{opens}]++" if opens else f"[{closes}]"


def inner(df: DataFrame, text: str, settings: SyncmerSettings) -> DataFrame:
    """Adds ``_h`` (hashes of the pieces) and ``_m`` (of the inner stretches).

    Each array is a column of its own that later steps name more than once, so that it is
    made once for each row and not once for each element.
    """
    pieces = F.regexp_extract_all(F.col(text), F.lit(piece_pattern(settings.stride)), F.lit(0))
    df = df.withColumn("_h", F.transform(pieces, lambda x: F.xxhash64(x)))
    inner_hash = lambda x, i: F.xxhash64(x, *[F.get(F.col("_h"), i + j) for j in range(1, settings.s)])
    return df.withColumn("_m", F.transform(F.slice("_h", 1, F.greatest(F.size("_h") - (settings.s - 1), F.lit(0))), inner_hash))


def starts(settings: SyncmerSettings) -> Column:
    """Where the kept stretches begin, as piece numbers."""
    width = settings.k - settings.s + 1
    at = lambda i, j: F.get(F.col("_m"), i + j)
    edge = lambda i: F.least(at(i, 0), at(i, width - 1))
    middle = lambda i: reduce(F.least, [at(i, j) for j in range(2, width - 1)], at(i, 1))
    last = F.size("_h") - settings.k
    kept = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: edge(i) <= middle(i))
    return F.when(last >= 0, kept).otherwise(F.array().cast("array<int>"))


def with_anchors(df: DataFrame, settings: SyncmerSettings, text: str = "text", out: str = "anchors") -> DataFrame:
    """Adds ``out``: ``array<struct<at, hash>>``, the anchors of ``text`` in their order.

    ``at`` counts pieces and ``hash`` has 32 bits. A text of fewer than ``k`` pieces is
    one anchor, a text without pieces has none; null gives none, too.
    """
    stretch = lambda i: F.xxhash64(*[F.get(F.col("_h"), i + j) for j in range(settings.k)])
    low = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))
    anchors = F.transform(F.col("_at"), lambda i: F.struct(i.alias("at"), low(stretch(i)).alias("hash")))
    short = F.array(F.struct(F.lit(0).alias("at"), low(F.xxhash64("_h")).alias("hash")))
    none = F.array().cast("array<struct<at:int,hash:bigint>>")
    df = inner(df, text, settings).withColumn("_at", starts(settings))
    found = F.when(F.size("_h") >= settings.k, anchors).when(F.size("_h") > 0, short).otherwise(none)
    return df.withColumn(out, found).drop("_h", "_m", "_at")


def with_fingerprint(df: DataFrame, settings: SyncmerSettings, text: str = "text", out: str = "fingerprint", links: str = "links") -> DataFrame:
    """Adds ``out``, the fingerprint as a string, and ``links``, the distinct links of all
    anchors of ``text``; a text of one anchor has that one as its link."""
    df = with_anchors(df, settings, text, "_anchors")
    follower = lambda i: F.get(F.col("_anchors"), i + 1)
    link = lambda x, i: F.xxhash64(x["hash"], follower(i)["at"] - x["at"], follower(i)["hash"])
    many = F.transform(F.slice("_anchors", 1, F.greatest(F.size("_anchors") - 1, F.lit(0))), link)
    lone = F.transform("_anchors", lambda x: x["hash"])
    smallest = F.slice(F.sort_array(F.array_distinct(F.transform("_anchors", lambda x: x["hash"]))), 1, settings.kept)
    string = F.concat(F.array_join(F.transform(smallest, lambda h: hexes(h, 8)), ""), hexes(F.xxhash64("_anchors"), 16))
    df = df.withColumn(out, F.when(F.size("_anchors") > 0, string).otherwise(""))
    return df.withColumn(links, F.array_distinct(F.when(F.size("_anchors") > 1, many).otherwise(lone))).drop("_anchors")


def hexes(number: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), width, "0")


def likeness(a: str, b: str) -> Column:
    """Share of their links that two texts have in common (Dice); 1 if both have none, 0 if
    one has."""
    n = F.size(a) + F.size(b)
    return F.when(n == 0, 1.0).otherwise(2 * F.size(F.array_intersect(a, b)) / F.greatest(n, F.lit(1)))


def key_ranges(df: DataFrame, settings: SyncmerSettings) -> Column:
    """The number of the key range a row belongs to, rising with the key.

    Percentiles give ``ranges`` parts of like size, each of which is split evenly. Null
    keys come first, in a range of their own.
    """
    steps = [i / settings.ranges for i in range(settings.ranges + 1)]
    bounds = sorted(set(df.agg(F.percentile_approx("key", steps)).first()[0] or []))
    parts = -(-4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // settings.ranges)
    if len(bounds) < 2:
        return F.when(F.col("key").isNull(), -1).otherwise(0).cast("long")
    edges = F.array(*[F.lit(b) for b in bounds[1:-1]]) if len(bounds) > 2 else F.array().cast("array<long>")
    coarse = F.size(F.filter(edges, lambda b: b <= F.col("key")))
    low, high = F.get(F.array(*[F.lit(b) for b in bounds]), coarse), F.get(F.array(*[F.lit(b) for b in bounds]), coarse + 1)
    fine = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor((F.col("key") - low) / (high - low) * parts)))
    return F.when(F.col("key").isNull(), -1).otherwise(coarse * parts + fine).cast("long")


def with_next(rows: DataFrame, settings: SyncmerSettings) -> DataFrame:
    """Adds ``fingerprint`` and ``links``, and ``next_text`` and ``next_links`` of the row after
    in key order; the first row comes after the last.

    Rows are dealt by key ranges and the window runs inside a range. The first row of
    each range also goes, as a copy, to the end of the range before it, so that the
    window finds it there; copies are told by their place and leave again. Of rows with
    one key and text one copy is enough.
    """
    rows = rows.withColumn("range", key_ranges(rows, settings)).withColumn("tie", F.xxhash64("text"))
    heads = rows.groupBy("range").agg(F.min(F.struct("key", "tie")).alias("h"))
    in_order = Window.orderBy("range")  # one row for each range
    last = F.max("range").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("h.key").alias("h_key"), F.col("h.tie").alias("h_tie"), F.coalesce(F.lag("range").over(in_order), last).alias("before"))
    at_head = F.col("key").eqNullSafe(F.col("h_key")) & (F.col("tie") == F.col("h_tie"))
    # a key and two numbers for each range, and there are at most 4 times as many ranges as partitions
    copies = rows.join(F.broadcast(heads), at_head).dropDuplicates(["before"]).withColumn("range", F.col("before")).drop("h_key", "h_tie", "before")
    order = ["copy", "key", "tie"]
    every = rows.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))
    # dealt and sorted as the window wants it, so that links are made behind the shuffle
    dealt = with_fingerprint(every.repartition("range").sortWithinPartitions("range", *order), settings)
    after = Window.partitionBy("range").orderBy(*order)
    led = dealt.withColumn("next_text", F.lead("text").over(after)).withColumn("next_links", F.lead("links").over(after))
    return led.where("NOT copy").drop("range", "tie", "copy")


@register("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return compare_edited(table(spark, sf, "documents"), SyncmerSettings())


def compare_edited(docs: DataFrame, settings: SyncmerSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, a row for each row.

    The edited text has its last half replaced by as many characters from the start of
    the next row's text, or by all of them. Null texts are empty; rows with equal keys
    are ordered by their texts' hashes, null keys come first. The only row is its own
    next one. Keys are whole numbers; ranges of keys are dealt, so repeats of one key
    meet in one range, where they are sorted with spilling. No rows give no rows; other
    columns play no part. A text without visible characters has the empty fingerprint.
    """
    rows = with_next(texts(docs, key, text).withColumn("key", F.col("key").cast("long")), settings)
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    rows = rows.withColumn("n_chars", size.cast("long")).withColumn("edited", F.concat(F.left("text", size - half), F.left("next_text", half)))
    rows = with_fingerprint(rows.drop("text", "next_text"), settings, "edited", "edited_fingerprint", "edited_links")
    return rows.select(
        F.col("key").alias(key),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("links", "edited_links").alias("near_edited"),
        likeness("links", "next_links").alias("near_next"),
    )
