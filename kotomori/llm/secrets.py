"""Secret scans with linking of credential parts, in DataFrame functions only.

Three kinds are reported wherever they stand: assignments, access identifiers and
hexadecimal keys. Weak candidates (account names, secret-looking values, endpoints) are
common in clean text; one is reported only if a complementary part lies within ``scope``
characters of it. Parts are intervals, and the join of weak parts with all parts runs on
(row, bucket of positions), so no text, however long, is one group. It is a semi join:
it keeps weak parts and makes no pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, table, texts
from kotomori.session import pin

# The three base patterns. Hexadecimal runs and access identifiers carry
# their least length in the pattern, which finds the same runs; an assignment that is too
# short still takes up its text, so it is found first and dropped after.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

IDENTIFIER = r"""(?i:user_?name|user_?id|user|login|account|client_?id|access_?key_?id|access_?key|host_?name|host)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
VALUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]+"""


@dataclass(frozen=True)
class SecretSettings:
    #: Characters between two parts of one credential, at most.
    scope: int = 200
    #: Characters in a bucket of the interval join.
    bucket: int = 1024
    least_assigned: int = 8


#: Kinds in the order in which spans with one start are listed; the first three are base.
KINDS = ("assign", "access", "hex", "identifier", "value", "endpoint")
#: What a kind can be part of: an identifier, a secret or an endpoint.
ROLES = (1, 0, 1, 0, 1, 2)
SPANS = "array<struct<start:int,kind:int,end:int>>"
#: Items of an array that are worked on at a time.
BLOCK = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(items: Column) -> Column:
    """A non-empty array in blocks of ``BLOCK``, the last one shorter."""
    return let(items, lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, BLOCK)))


def scanned(items: Column, kind: str, first: Column, total, step) -> Column:
    """``step(before, item)`` for each item of a non-empty array, where ``before`` is
    ``first`` combined by ``total`` with all items that stand before it.

    An array that is grown by one is copied each time. Here only arrays of a block, and
    one of block heads, are grown, so long arrays do not cost their square.
    """
    none = F.array().cast(f"array<{kind}>")

    def befores(part: Column, start: Column) -> Column:
        grow = lambda at, x: F.struct(total(at["at"], x).alias("at"), F.array_append(at["all"], at["at"]).alias("all"))
        return F.aggregate(part, F.struct(start.cast(kind).alias("at"), none.alias("all")), grow, lambda at: at["all"])

    def over(parts: Column) -> Column:
        # What a block adds to any start is found from its items alone; heads follow from these.
        ends = lambda at, part: F.struct(F.aggregate(part, at["at"], total).alias("at"), F.array_append(at["all"], at["at"]).alias("all"))
        heads = F.aggregate(parts, F.struct(first.cast(kind).alias("at"), none.alias("all")), ends, lambda at: at["all"])
        return F.flatten(F.zip_with(parts, heads, lambda part, head: F.zip_with(befores(part, head), part, step)))

    return let(blocks(items), over)


def found(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Matches of ``pattern``, leftmost and not overlapping, as spans in code points.

    The text between matches and the matches, in turn, give the positions.
    """
    p = F.lit(pattern)
    keep = keep or (lambda m: F.lit(True))
    matches = F.regexp_extract_all(text, p, F.lit(0))
    piece = lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"), keep(m).alias("kept"))
    # The gap behind the last match belongs to no match.
    pieces = F.filter(F.zip_with(F.split(text, p, -1), matches, piece), lambda x: x["size"].isNotNull())
    span = lambda at, x: F.struct((at + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + x["gap"] + x["size"]).alias("end"), x["kept"].alias("kept"))
    spans = scanned(pieces, "int", F.lit(0), lambda at, x: at + x["gap"] + x["size"], span)
    spans = F.transform(F.filter(spans, lambda s: s["kept"]), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), spans.cast(SPANS)).otherwise(F.array().cast(SPANS))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def has_role(spans: Column, role: int) -> Column:
    return F.exists(spans, lambda s: F.get(F.array(*[F.lit(r) for r in ROLES]), s["kind"]) == role)


def find_secrets(docs: DataFrame, settings: SecretSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, digest, base, linked)``, a row for each row of ``docs``.

    ``base`` and ``linked`` are ``array<struct<start, kind, end>>``: spans found for
    themselves and spans reported for their neighbours; kinds are numbers into
    ``KINDS``. ``digest`` is a hash of the text, to find the row again. A null or empty
    text has no spans; null or repeated keys and repeated rows keep a row each.
    """
    t = F.col("text")
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= settings.least_assigned
    scan = (
        texts(docs, key, text)
        .select("key", F.xxhash64("text").alias("digest"), found(t, ASSIGN, 0, long_enough).alias("a"), found(t, ACCESS, 1).alias("b"), found(t, HEX, 2).alias("c"),
                found(t, IDENTIFIER, 3).alias("d"), found(t, VALUE, 4).alias("e"), found(t, ENDPOINT, 5).alias("f"))
        .select(F.monotonically_increasing_id().alias("row"), "key", "digest", F.concat("a", "b", "c").alias("base"), F.concat("d", "e", "f").alias("weak"))
    )
    rows = pin(scan, "secret-parts")  # rows keep their number from here on

    role = lambda kind: F.get(F.array(*[F.lit(r) for r in ROLES]), kind)
    every = F.concat("base", "weak")
    candidates = rows.where((F.size("weak") > 0) & has_role(every, 1) & (has_role(every, 0) | has_role(every, 2)))
    parts = candidates.select("row", F.explode(every).alias("p")).select("row", "p.*", role(F.col("p.kind")).alias("role"))
    weak = parts.where(F.col("kind") >= 3).withColumn("low", F.col("start") - settings.scope).withColumn("high", F.col("end") + settings.scope)
    buckets = lambda a, b: F.explode(F.sequence(F.floor(F.greatest(a, F.lit(0)) / settings.bucket), F.floor(b / settings.bucket)))
    left = weak.withColumn("bucket", buckets(F.col("low"), F.col("high"))).alias("l")
    right = parts.withColumn("bucket", buckets(F.col("start"), F.col("end"))).alias("r")
    # A secret goes with an identifier or an endpoint, and each of these with a secret.
    complementary = (F.col("l.role") == 1) != (F.col("r.role") == 1)
    apart = (F.col("r.start") < F.col("l.high")) & (F.col("r.end") > F.col("l.low"))
    linked = left.join(right, (F.col("l.row") == F.col("r.row")) & (F.col("l.bucket") == F.col("r.bucket")) & complementary & apart, "left_semi")
    linked = linked.groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("linked"))  # spans of one text
    return rows.join(linked, "row", "left").select(F.col("key").alias(key), "digest", "base", F.coalesce(F.col("linked").cast(SPANS), F.array().cast(SPANS)).alias("linked"))


def merged(spans: Column) -> Column:
    """A non-empty array of spans in order, overlapping ones as one ``(start, end)``.

    A span opens a new one if it starts where all before it have ended, and the new one
    ends where those before the next opening end.
    """
    mark = lambda reach, s: F.struct(s["start"].alias("start"), reach.alias("reach"))
    marks = scanned(F.sort_array(spans), "int", F.lit(-1), lambda reach, s: F.greatest(reach, s["end"]), mark)
    last = F.array_max(F.transform(spans, lambda s: s["end"]))

    def closed(opening: Column) -> Column:
        ends = F.array_append(F.transform(F.slice(opening, 2, F.size(opening)), lambda m: m["reach"]), last)
        return F.zip_with(opening, ends, lambda m, end: F.struct(m["start"].alias("start"), end.alias("end")))

    return let(F.filter(marks, lambda m: m["start"] >= m["reach"]), closed)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with ``mark`` in place of each span, of which there is one at least.

    A block of spans takes its stretch of the text first, and its gaps from that.
    """
    def gaps(apart: Column) -> Column:
        # What stays: up to the first span, between neighbours, and behind the last.
        starts = F.array_prepend(F.transform(apart, lambda s: s["end"]), F.lit(0))
        ends = F.array_append(F.transform(apart, lambda s: s["start"]), F.length(text))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end"))).cast("array<struct<start:int,end:int>>")

    def cut(part: Column) -> Column:
        low, high = F.get(part, F.lit(0))["start"], F.element_at(part, -1)["end"]
        return let(F.struct(low.alias("low"), F.substr(text, low + 1, high - low).alias("t")), lambda x: F.transform(part, lambda g: F.substr(x["t"], g["start"] - x["low"] + 1, g["end"] - g["start"])))

    return F.array_join(F.flatten(F.transform(blocks(let(merged(spans), gaps)), cut)), mark)


def redact(docs: DataFrame, settings: SecretSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all secrets replaced in ``text``; every row and column stays.

    Only rows with spans meet the spans; the others, found by the same patterns to have no
    part at all, pass by without a shuffle. Null texts stay null, an empty table stays
    empty, repeated rows are replaced alike, and other columns may have any names.
    """
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    may = F.lit(False)
    for pattern in (ASSIGN, ACCESS, HEX):
        may = may | column.rlike(pattern)  # linked parts need a secret, so a value or one of these
    may = may | column.rlike(VALUE)
    spans = find_secrets(docs.where(may), settings, key, text).where((F.size("base") > 0) | (F.size("linked") > 0))
    own = "own"  # names of helper columns, made longer until no column of ``docs`` begins with them
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    spans = spans.select(F.col(f"`{key}`").alias(f"{own}key"), F.col("digest").alias(f"{own}digest"), F.concat("base", "linked").alias(f"{own}spans")).dropDuplicates([f"{own}key", f"{own}digest"])
    mine = docs.where(may).withColumn(own, F.xxhash64(column))
    joined = mine.join(spans, F.col(f"`{key}`").eqNullSafe(F.col(f"{own}key")) & (F.col(own) == F.col(f"{own}digest")), "left")
    clean = F.when(F.col(f"{own}spans").isNotNull(), redacted(F.col(f"`{text}`"), F.col(f"{own}spans"))).otherwise(F.col(f"`{text}`"))
    return joined.withColumn(text, clean).select(*[f"`{c}`" for c in docs.columns]).unionByName(docs.where(~may))


@register("op8_secrets")
def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    spans = find_secrets(table(spark, sf, "documents"), SecretSettings())
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "linked")).alias("spans"),
    )
