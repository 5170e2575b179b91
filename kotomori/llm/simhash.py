"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, where neighbours differ in one bit, and
cut into leaves of equal size. A node knows the bits that all its fingerprints share (a
mask and a pattern); ``fan`` neighbouring nodes have a parent whose mask is what their
patterns have in common. Two nodes whose patterns differ in more than ``radius`` common
bits hold no link, and neither do any nodes below them.

The index is joined with itself from the root down, a level at a time: a pair of nodes
becomes the pairs of their children, and pairs with too many differences go. Both steps
are equi joins on the parents' numbers, so no task or driver holds the index, and leaves
have a bounded size whatever the data. Pairs of leaves that are left are compared
exactly. A dense pair of leaves hands on a spanning forest of its links instead of all of
them, which loses no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, slices, table, texts
from kotomori.session import pin


@dataclass(frozen=True)
class SimHashSettings:
    shingle: int = 3
    seed: int = 42
    #: Fingerprints with at most so many differing bits are linked.
    radius: int = 2
    #: Fingerprints in a leaf and children of a node.
    leaf: int = 128
    fan: int = 16


def fingerprint(text: str, settings: SimHashSettings) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()  # of bytes: lowers A-Z and splits at ASCII space alone
    k = settings.shingle
    if not words:
        return 0
    shingles = list(map(b" ".join, zip(*(words[i:] for i in range(min(k, len(words)))))))
    digest, seed = xxhash.xxh64_digest, settings.seed
    hashes = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=np.uint8).reshape(-1, 8)
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 8192):
        votes += np.unpackbits(hashes[start : start + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, settings: SimHashSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, bits)``: the fingerprint of every row as a signed long."""
    rows = texts(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches):
            bits = np.array([fingerprint(t, settings) for t in part], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(bits)], ["key", "bits"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, bits long").withColumnRenamed("key", key)


def gray_rank(bits: Column) -> Column:
    """The place of a bit pattern in Gray order, as a long that sorts like unsigned."""
    for k in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, k))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def leaves(distinct: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``(part, local, pattern, ones, members)``: runs of fingerprints in Gray order.

    ``pattern`` is the AND of the members and ``ones`` their OR.
    """
    ordered = distinct.select("bits", gray_rank(F.col("bits")).alias("rank")).repartitionByRange("rank").sortWithinPartitions("rank").select("bits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at, held = TaskContext.get().partitionId(), 0, np.empty(0, np.int64)

        def flush(rows: np.ndarray, at: int) -> pa.RecordBatch:
            blocks = [rows[i : i + settings.leaf] for i in range(0, len(rows), settings.leaf)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([place] * len(blocks), pa.int32()),
                    pa.array(range(at, at + len(blocks)), pa.int64()),
                    pa.array([np.bitwise_and.reduce(b) for b in blocks], pa.int64()),
                    pa.array([np.bitwise_or.reduce(b) for b in blocks], pa.int64()),
                    pa.array([b.tobytes() for b in blocks], pa.binary()),
                ],
                ["part", "local", "pattern", "ones", "members"],
            )

        for batch in batches:
            held = np.concatenate([held, batch.column("bits").to_numpy()])
            whole = len(held) // settings.leaf * settings.leaf
            if whole:
                yield flush(held[:whole], at)
                at, held = at + whole // settings.leaf, held[whole:]
        if len(held):
            yield flush(held, at)

    return ordered.mapInArrow(cut, "part int, local long, pattern long, ones long, members binary")


def numbered(leaf: DataFrame) -> DataFrame:
    """Leaves with their number in the whole order; one row per part sets the offsets."""
    counts = {r.part: r.n for r in leaf.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row per partition
    offset, offsets = 0, []
    for part in sorted(counts):
        offsets.append((part, offset))
        offset += counts[part]
    known = leaf.sparkSession.createDataFrame(offsets, "part int, first long")
    return leaf.join(known, "part").select((F.col("first") + F.col("local")).alias("node"), "pattern", "ones", "members")


def differences(a: str, b: str) -> Column:
    """Bits in which the shared patterns of two nodes differ."""
    varies = F.col(f"{a}.pattern").bitwiseXOR(F.col(f"{a}.ones")).bitwiseOR(F.col(f"{b}.pattern").bitwiseXOR(F.col(f"{b}.ones")))
    return F.bit_count(F.col(f"{a}.pattern").bitwiseXOR(F.col(f"{b}.pattern")).bitwiseAND(F.bitwise_not(varies)))


def leaf_pairs(leaf: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``(a, b)`` with ``a <= b``: pairs of leaves that the index cannot rule out."""
    levels = [leaf.select("node", "pattern", "ones")]
    size = leaf.count()
    while size > 1:
        parent = F.floor(F.col("node") / settings.fan).alias("node")
        levels.append(levels[-1].groupBy(parent).agg(F.bit_and("pattern").alias("pattern"), F.bit_or("ones").alias("ones")))
        size = -(-size // settings.fan)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))  # the root, if anything
    for level in reversed(levels[:-1]):
        child = level.withColumn("parent", F.floor(F.col("node") / settings.fan))
        pairs = (
            pairs.join(child.alias("l"), F.col("a") == F.col("l.parent"))
            .join(child.alias("r"), F.col("b") == F.col("r.parent"))
            .where((F.col("l.node") <= F.col("r.node")) & (differences("l", "r") <= settings.radius))
            .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        )
    return pairs


def spanning(x: np.ndarray, y: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two leaves, thinned to a spanning forest of them."""
    near = np.bitwise_count((x[:, None] ^ y[None, :]).view(np.uint64)) <= radius  # of signed numbers it counts the absolute value's
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if len(i) <= len(x) + len(y):
        return x[i], y[j]
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    kept = []
    for n, (a, b) in enumerate(zip(x[i].tolist(), y[j].tolist())):
        a, b = find(a), find(b)
        if a != b:
            root[a] = b
            kept.append(n)
    return x[i[kept]], y[j[kept]]


def links(distinct: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (column ``bits``), enough of them
    to connect all that are linked."""
    leaf = pin(numbered(pin(leaves(distinct, settings), "leaves")), "numbered-leaves")
    pairs = leaf_pairs(leaf, settings)
    members = leaf.select("node", "members")
    both = (
        pairs.join(members.withColumnsRenamed({"node": "a", "members": "left"}), "a")
        .join(members.withColumnsRenamed({"node": "b", "members": "right"}), "b")
        .select((F.col("a") == F.col("b")).alias("same"), "left", "right")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                spanning(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), same, settings.radius)
                for same, x, y in zip(*(c.to_pylist() for c in batch.columns))
            ]
            a, b = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)``: the smallest node it can reach.

    Each round every node takes the smallest root around it, then its root's root, until
    nothing changes. Labels and edges are written tables between rounds, and edges within
    a root go, so later rounds have less to read.
    """
    edges = pin(edges, "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    left = edges.select(F.col("a").alias("x"), F.col("b").alias("y"))  # between roots
    while True:
        left = pin(left.where("x <> y").distinct(), "root-edges")
        if left.isEmpty():
            return labels
        both = left.union(left.select("y", "x"))
        down = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("root"), F.least("x", "y").alias("next"))
        for _ in range(3):  # pointer jumping
            jump = down.select(F.col("root").alias("next"), F.col("next").alias("after"))
            down = pin(down.join(jump, "next", "left").select("root", F.coalesce("after", "next").alias("next")), "jumps")
        labels = pin(labels.join(down, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        step = lambda c, down=down: down.select(F.col("root").alias(c), F.col("next").alias(f"{c}2"))
        left = left.join(step("x"), "x", "left").join(step("y"), "y", "left").select(F.coalesce("x2", "x").alias("x"), F.coalesce("y2", "y").alias("y"))


def near_duplicates(docs: DataFrame, settings: SimHashSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint, component_id)``: one row for each row of ``docs``.

    ``component_id`` is the smallest key that links of at most ``radius`` bits lead to. A
    null or empty text has fingerprint 0 and is linked like any other. Null keys are
    never a component's smallest key unless it has no other. Repeated rows keep a row
    each. Fewer words than a shingle make one shingle.
    """
    rows = pin(fingerprints(docs, settings, key, text), "fingerprints")
    groups = pin(rows.groupBy("bits").agg(F.min(key).alias("first")), "groups")
    linked = components(links(groups, settings)).withColumnsRenamed({"node": "bits"})
    joined = groups.join(linked, "bits")
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    merged = joined.join(smallest, "root").select("bits", "component_id")
    heads = groups.join(merged, "bits", "left").select("bits", F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(heads, "bits").select(key, F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


@register("op5_simhash")
def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), SimHashSettings())
