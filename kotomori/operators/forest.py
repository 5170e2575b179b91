"""A random forest on sparse rows, grown by Spark jobs into Spark's own model.

Spark's fit sends the counts of all bins of all features drawn for a node from each partition,
rows or none, so its shuffle grows with nodes times partitions. Here rows are binned once and
kept in packed chunks. A node of more than ``IN_TASK`` rows is split from histograms that tasks
add up; the rows of a smaller one meet in a task, which grows the rest below it. A split
looks at cells that are not zero only.

The rules are Spark's: Poisson bags drawn by partition, 32 bins by quantiles of 10,000 rows, features
drawn anew for each node, weighted Gini gain, leaves of one prediction merged.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.session import pin, shared_folder

#: Rows of a node that a task grows by itself, and cells of so many rows on average.
IN_TASK, IN_TASK_CELLS = 1 << 17, 1 << 25
#: Whole trees that a task grows from the same rows.
TOGETHER = 4
#: Rows and cells of a packed chunk.
CHUNK_ROWS, CHUNK_CELLS = 1 << 12, 1 << 20
BINS, SAMPLE = 32, 10_000
#: Rows of a node that is split together with others; pairs of rows and features of such a batch.
SMALL, PAIRS = 1 << 9, 1 << 18
#: Bytes of a table of rows and features, and rows that enter it at a time.
DENSE, FILL = 1 << 28, 1 << 12
#: Bytes of the rows that are scored together.
SCORED = 1 << 24

PACKED = {"label": np.uint8, "copies": np.uint8, "size": np.int32, "index": np.int32, "bin": np.uint8}
PACKED_DDL = ", ".join(f"{name} binary" for name in PACKED)
NODE_TYPES = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
NODE = "at int, prediction double, impurity double, counts array<double>, raw long, gain double, left int, right int, feature int, threshold double"


@dataclass
class Rows:
    """Binned rows: the cells of row ``i`` are ``index`` and ``bin`` from ``start[i]`` to ``start[i + 1]``."""

    label: np.ndarray
    copies: np.ndarray  # in the bag; a column a tree in a chunk
    size: np.ndarray
    index: np.ndarray
    bin: np.ndarray

    def __post_init__(self):
        self.start = np.append(0, np.cumsum(self.size, dtype=np.int64))
        self.by_feature = self.dense = None

    def file_by_feature(self, n_features: int) -> None:
        """Keep the cells by feature too, for nodes whose rows have more cells than a few features."""
        index = self.index.astype(np.uint16) if n_features <= 1 << 16 else self.index
        order = np.argsort(index, kind="stable")
        first = np.append(0, np.cumsum(np.bincount(index, minlength=n_features)))
        self.by_feature = first, np.repeat(np.arange(len(self.size), dtype=np.int32), self.size)[order], self.bin[order]
        self.place = np.full(len(self.size), -1, np.int32)

    def cells_of(self, at: np.ndarray, features: np.ndarray, slot: np.ndarray, zero_bin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place of the feature, place of the row, bin)`` of the cells of some rows and features;
        of a table, those that are not in the bin of zero."""
        if self.dense is not None:
            beside = self.dense[at[:, None], features].ravel()
            found = np.flatnonzero(beside)
            owner = found // len(features)
            which = found - owner * len(features)
            return which, owner, beside[found] + zero_bin[features][which]
        if self.by_feature is not None:
            first, row, bins = self.by_feature
            n = first[features + 1] - first[features]
            if n.sum() < self.size[at].sum():
                which = np.repeat(np.arange(len(features)), n)
                cells = np.arange(len(which)) + (first[features] - np.cumsum(n) + n)[which]
                self.place[at] = np.arange(len(at))
                owner = self.place[row[cells]]
                self.place[at] = -1
                kept = owner >= 0
                return which[kept], owner[kept], bins[cells[kept]]
        cells, owner = self.cells(at)
        slot[features] = np.arange(len(features))
        which = slot[self.index[cells]].astype(np.int64)
        slot[features] = -1
        kept = which >= 0
        return which[kept], owner[kept], self.bin[cells[kept]]

    def tabled(self, n_features: int) -> bool:
        return len(self.size) * n_features <= DENSE

    def table(self, zero_bin: np.ndarray) -> None:
        """Keep all rows as a table, if it is not too large: bins as steps from the bin of zero, modulo 256."""
        if self.dense is None and self.tabled(len(zero_bin)):
            self.dense = np.zeros((len(self.size), len(zero_bin)), np.uint8)
            for low in range(0, len(self.size), FILL):
                size = self.size[low : low + FILL]
                start, end = self.start[low], self.start[low + len(size)]
                index = self.index[start:end]
                self.dense[np.repeat(np.arange(low, low + len(size)), size), index] = self.bin[start:end] - zero_bin[index]

    def beside_zero(self, at: np.ndarray, owner: np.ndarray, features: np.ndarray, zero_bin: np.ndarray) -> np.ndarray:
        """The bins of some rows, each in the features of its owner, a row a row, as steps from the
        bin of zero modulo 256."""
        n = len(zero_bin)
        if self.dense is not None:
            return self.dense.ravel().take((at * n)[:, None] + features[owner])
        found = np.zeros((len(at), features.shape[1]), np.uint8)
        slots = max(DENSE // 4 // n, 1)
        for low in range(0, len(features), slots):  # nodes whose features fit a table together
            some = features[low : low + slots]
            slot = np.full((len(some), n), -1, np.int32)
            slot[np.arange(len(some))[:, None], some] = np.arange(some.shape[1])
            start, end = np.searchsorted(owner, (low, low + len(some)))
            cells, mine = self.cells(at[start:end])
            which = slot[owner[start:end][mine] - low, self.index[cells]]
            kept = which >= 0
            found[start + mine[kept], which[kept]] = self.bin[cells[kept]] - zero_bin[self.index[cells[kept]]]
        return found

    def cells(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cells of some rows, and which of these rows each is of."""
        size = self.size[at]
        owner = np.repeat(np.arange(len(at)), size)
        ends = np.cumsum(size, dtype=np.int64)
        return np.arange(len(owner)) + (self.start[at] - ends + size)[owner], owner

    def packed(self, at: np.ndarray, copies: np.ndarray) -> dict[str, bytes]:
        cells, _ = self.cells(at)
        each = {"label": self.label[at], "copies": copies, "size": self.size[at], "index": self.index[cells], "bin": self.bin[cells]}
        kinds = PACKED | ({"index": np.uint16} if self.index.dtype == np.uint16 else {})
        return {name: np.ascontiguousarray(x, kinds[name]).tobytes() for name, x in each.items()}

    @classmethod
    def unpacked(cls, records: list[dict[str, bytes]]) -> Rows:
        narrow = all(len(r["index"]) == 2 * len(r["bin"]) for r in records)  # a bin is a byte
        kinds = PACKED | ({"index": np.uint16} if narrow else {})
        return cls(**{name: np.concatenate([np.frombuffer(r[name], kind) for r in records]) for name, kind in kinds.items()})


@dataclass
class Growth:
    """What tasks need to split nodes."""

    classes: int
    weights: np.ndarray  # of a row, by class
    first: np.ndarray  # the thresholds of feature f are thresholds[first[f]:first[f + 1]]
    thresholds: np.ndarray
    trees: int
    max_depth: int
    min_instances: int
    seed: int

    def __post_init__(self):
        self.n_features = len(self.first) - 1
        self.zero_bin = self.bins(np.arange(self.n_features), np.zeros(self.n_features))
        self.slot = np.full(self.n_features, -1, np.int32)

    def bins(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many thresholds of its feature lie below each value."""
        low, high = self.first[feature], self.first[feature + 1]
        start = low
        while len(low) and (low < high).any():
            middle = (low + high) // 2
            open_, below = low < high, self.thresholds[np.minimum(middle, max(len(self.thresholds) - 1, 0))] < value
            low, high = np.where(open_ & below, middle + 1, low), np.where(open_ & ~below, middle, high)
        return (low - start).astype(np.uint8)

    def drawn(self, tree: int, node: int) -> np.ndarray:
        return np.random.default_rng([self.seed, tree, node]).choice(self.n_features, math.ceil(math.sqrt(self.n_features)), replace=False)

    def impurity(self, counts: np.ndarray) -> float:
        p = counts * self.weights
        return 1.0 - float(((p / p.sum()) ** 2).sum())

    def ends(self, counts: np.ndarray, depth: int) -> bool:
        return depth >= self.max_depth or np.count_nonzero(counts) < 2 or counts.sum() < 2 * self.min_instances

    def histogram(self, rows: Rows, at: np.ndarray, copies: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Copies by feature, bin and class, and rows behind the classes."""
        c, m = self.classes, len(features)
        which, owner, bins = rows.cells_of(at, features, self.slot, self.zero_bin)
        place = which * BINS + bins
        label = rows.label[at]
        found = np.empty((m, BINS, c + 1), np.int64)
        by_class = np.bincount(place * c + label[owner], weights=copies[owner], minlength=m * BINS * c)
        found[..., :c] = by_class.reshape(m, BINS, c)
        found[..., c] = np.bincount(place, minlength=m * BINS).reshape(m, BINS)
        total = np.append(np.bincount(label, weights=copies, minlength=c), len(at)).astype(np.int64)
        found[np.arange(m), self.zero_bin[features]] += total - found.sum(axis=1)
        return found

    def best(self, found: np.ndarray, features: np.ndarray) -> tuple[int, int, float] | None:
        """``(place of the feature, bin, gain)`` of the best split, rows up to the bin go left."""
        c = self.classes
        left = found[..., :c].cumsum(axis=1)
        total = left[0, -1]
        n_left, n = left[:, :-1].sum(axis=2), total.sum()
        splits = (self.first[features + 1] - self.first[features])[:, None]
        least = max(self.min_instances, 1)
        valid = np.flatnonzero((n_left >= least) & (n - n_left >= least) & (np.arange(BINS - 1) < splits))
        if not len(valid):
            return None
        left = left[:, :-1].reshape(-1, c)[valid]
        parts = 0.0
        for side in (left, total - left):
            w = side * self.weights
            whole = w.sum(axis=1)
            parts = parts + whole - (w * w).sum(axis=1) / whole
        gain = self.impurity(total) - parts / (total * self.weights).sum()
        where = int(gain.argmax())
        return (*divmod(int(valid[where]), BINS - 1), float(gain[where])) if gain[where] > 1e-12 else None

    def goes_left(self, rows: Rows, at: np.ndarray, feature: int, bin: int) -> np.ndarray:
        if rows.dense is not None:
            return rows.dense[at, feature] + self.zero_bin[feature] <= bin
        _, owner, bins = rows.cells_of(at, np.array([feature]), self.slot, self.zero_bin)
        value = np.full(len(at), self.zero_bin[feature])
        value[owner] = bins
        return value <= bin

    def leaf(self, at: int, counts: np.ndarray) -> list:
        w = counts * self.weights
        return [at, float(w.argmax()), self.impurity(counts), w.tolist(), int(counts.sum()), -1.0, -1, -1, -1, None]

    def best_of_small(self, beside: np.ndarray, rows: Rows, at: np.ndarray, owner: np.ndarray, counts: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, ...]:
        """:meth:`best` of many nodes at once: the nodes that have one, its feature's place, bin and gain, and the
        counts to the left. ``beside`` holds a row a row and a column a drawn feature, as
        :meth:`Rows.beside_zero` gives it; rows are in the order of their nodes, ``owner``. Cells in
        the bin of zero are not looked at: what the others leave of a node is theirs."""
        n, m = features.shape
        zero = self.zero_bin[features].ravel()
        found = np.flatnonzero(beside)
        row = found // m
        slot = owner[row] * m + (found - row * m)
        bins = beside.ravel()[found] + zero[slot]
        low, high = int(rows.copies[at].max(initial=0)).bit_length(), (self.classes - 1).bit_length()  # bits of copies, classes
        kind = np.uint32 if n * m * BINS << low + high < 1 << 32 else np.int64
        about = (rows.label[at].astype(kind) << low) + rows.copies[at]
        keys = np.sort(((slot * BINS + bins).astype(kind) << low + high) + about[row])
        copies, label, cell = keys & (1 << low) - 1, keys >> low & (1 << high) - 1, (keys >> low + high).astype(np.int64)
        ends = np.flatnonzero(np.append(cell[1:] != cell[:-1], True)) if len(cell) else np.empty(0, np.int64)  # of the filled bins of a feature
        cell, slots, node_of = cell[ends], np.arange(n * m), np.repeat(np.arange(n), m)
        each = [np.diff(np.cumsum(np.where(label == c, copies, 0), dtype=np.int64)[ends], prepend=0) for c in range(self.classes)]
        rest = [counts[node_of, c] - np.bincount(cell // BINS, weights=x, minlength=n * m).astype(np.int64) for c, x in enumerate(each)]
        some = np.flatnonzero(np.any(rest, axis=0))
        zero_cell = slots[some] * BINS + zero[some]
        place = np.searchsorted(cell, zero_cell)
        cell = np.insert(cell, place, zero_cell)
        slot, bin = cell // BINS, cell % BINS
        node = slot // m
        before = np.cumsum(counts, axis=0) - counts  # of the nodes ahead, each of whose features counts all its rows
        total = [counts[node, c] for c in range(self.classes)]
        left = [np.cumsum(np.insert(each[c], place, rest[c][some])) - before[node, c] * m - counts[node, c] * (slot - node * m) for c in range(self.classes)]
        n_left, whole, least = sum(left), counts.sum(axis=1)[node], max(self.min_instances, 1)
        chosen = features.ravel()[slot]
        valid = np.flatnonzero((n_left >= least) & (whole - n_left >= least) & (bin < self.first[chosen + 1] - self.first[chosen]))
        if not len(valid):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0), np.empty((0, self.classes), np.int64))
        left, total, slot, bin, node = [x[valid] for x in left], [x[valid] for x in total], slot[valid], bin[valid], node[valid]
        parts = 0.0
        for side in (left, [t - x for t, x in zip(total, left)]):
            w = [x * weight for x, weight in zip(side, self.weights)]
            whole = sum(w[1:], w[0])
            parts = parts + whole - sum((x * x for x in w[1:]), w[0] * w[0]) / whole
        w = counts * self.weights
        impurity = 1.0 - ((w / w.sum(axis=1)[:, None]) ** 2).sum(axis=1)
        gain = impurity[node] - parts / w.sum(axis=1)[node]
        starts = np.flatnonzero(np.diff(node, prepend=-1))
        most = np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.append(starts, len(gain))))
        where = np.flatnonzero((gain == most) & (gain > 1e-12))
        i = where[np.flatnonzero(np.diff(node[where], prepend=-1))]
        return node[i], slot[i] % m, bin[i], gain[i], np.stack([x[i] for x in left], axis=1)

    def grown(self, rows: Rows, tree: int, root: int) -> list[list]:
        """The nodes below ``root``, itself first, a node before its left side and that before its right,
        from the rows that have copies. Grown by level: small nodes are split together, large ones one by one."""
        counts = {root: np.bincount(rows.label, weights=rows.copies, minlength=self.classes).astype(np.int64)}
        splits: dict[int, tuple[int, int, float]] = {}

        def open_(n: np.ndarray, depth: int) -> np.ndarray:
            """Which of some nodes of a depth, by their counts, do not end."""
            return (depth < self.max_depth) & (np.count_nonzero(n, axis=1) >= 2) & (n.sum(axis=1) >= 2 * self.min_instances)

        def split_large(node: int, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            if rows.by_feature is None:
                rows.file_by_feature(self.n_features)
            features = self.drawn(tree, node)
            found = self.histogram(rows, at, rows.copies[at], features)
            best = self.best(found, features)
            if best is not None:
                f, bin, gain = best
                side = self.goes_left(rows, at, int(features[f]), bin)
                splits[node] = int(features[f]), bin, gain
                counts[2 * node] = found[f, : bin + 1, : self.classes].sum(axis=0)
                counts[2 * node + 1] = counts[node] - counts[2 * node]
                for child, some in ((2 * node, side), (2 * node + 1, ~side)):
                    if not self.ends(counts[child], child.bit_length() - 1):
                        yield child, at[some]

        def split_small(some: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
            features = np.stack([self.drawn(tree, node) for node, _ in some])
            each = [len(at) for _, at in some]
            at, owner = np.concatenate([at for _, at in some]), np.repeat(np.arange(len(some)), each)
            beside, n = rows.beside_zero(at, owner, features, self.zero_bin), np.stack([counts[node] for node, _ in some])
            which, slot, bin, gain, left = self.best_of_small(beside, rows, at, owner, n, features)
            feature, right, depth = features[which, slot], n[which] - left, some[0][0].bit_length()
            ends, goes = np.cumsum(each), np.stack([open_(left, depth), open_(right, depth)], axis=1).tolist()
            for i, k, f, *split in zip(range(len(which)), which.tolist(), feature.tolist(), slot.tolist(), bin.tolist(), gain.tolist()):
                node, mine = some[k]
                splits[node] = f, *split[1:]
                counts[2 * node], counts[2 * node + 1] = left[i], right[i]
                if any(goes[i]):
                    side = beside[ends[k] - len(mine) : ends[k], split[0]] + self.zero_bin[f] <= split[1]
                    if goes[i][0]:
                        yield 2 * node, mine[side]
                    if goes[i][1]:
                        yield 2 * node + 1, mine[~side]

        level = [] if self.ends(counts[root], root.bit_length() - 1) else [(root, np.flatnonzero(rows.copies))]
        drawn = max(math.ceil(math.sqrt(self.n_features)), 1)
        rows.table(self.zero_bin)
        while level:
            below, batch, held = [], [], 0
            for node, at in level:
                if rows.dense is None and len(at) > SMALL:
                    below += split_large(node, at)
                    continue
                batch.append((node, at))
                held += len(at) * drawn
                if held > PAIRS:
                    below += split_small(batch)
                    batch, held = [], 0
            if batch:
                below += split_small(batch)
            level = below
        return self.listed(root, counts, splits)

    def listed(self, root: int, counts: dict[int, np.ndarray], splits: dict[int, tuple[int, int, float]]) -> list[list]:
        """The nodes as the model has them; sides that are leaves of one prediction become one leaf."""
        number = {node: i for i, node in enumerate(counts)}
        n = np.array(list(counts.values()))
        w = n * self.weights
        said, each, raw = w.argmax(axis=1).astype(float).tolist(), w.tolist(), n.sum(axis=1).tolist()
        impurity = (1.0 - ((w / w.sum(axis=1)[:, None]) ** 2).sum(axis=1)).tolist()
        nodes: list[list] = []

        def add(node: int) -> int:
            me, i = len(nodes), number[node]
            nodes.append([me, said[i], impurity[i], each[i], raw[i], -1.0, -1, -1, -1, None])
            if node in splits:
                feature, bin, gain = splits[node]
                left, right = add(2 * node), add(2 * node + 1)
                nodes[me][5:] = [gain, left, right, feature, float(self.thresholds[self.first[feature] + bin])]
                _merge(nodes, me)
            return me

        add(root)
        return nodes


def thresholds(values: np.ndarray, weights: np.ndarray, total: float, splits: int) -> list[float]:
    """Between the values of a feature, or, of very many, near their quantiles; what is not
    listed of the total weight is zero."""
    rest = total - weights.sum()
    if rest > 1e-9 * total:
        values, weights = np.append(values, 0.0), np.append(weights, rest)
    values, at = np.unique(values, return_inverse=True)
    counts, between = np.bincount(at, weights=weights), (values[1:] + values[:-1]) / 2
    if len(between) <= splits:
        return between.tolist()
    stride, found = total / (splits + 1), []
    target, upto = stride, counts.cumsum().tolist()
    for i, cut in enumerate(between.tolist()):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            found.append(cut)
            target += stride
    return found[:splits]


def _merge(nodes: list[list], me: int) -> None:
    """Make a node a leaf if its sides, the last of ``nodes``, are leaves of one prediction."""
    left, right = (nodes[i] for i in nodes[me][6:8])
    if left[6] < 0 and right[6] < 0 and left[1] == right[1]:
        nodes[me][5:] = [-1.0, -1, -1, -1, None]
        del nodes[me + 1 :]


@dataclass
class Top:
    """A node above the subtrees, by its number in a heap; the root is 1."""

    counts: np.ndarray
    rows: int
    split: tuple[int, int, float] | None = None  # feature, bin, gain
    leaf: bool = False


def _routed(growth: Growth, top: dict[int, Top], rows: Rows, at: np.ndarray, node: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """The unsplit nodes that rows come to."""
    split = top[node].split
    if split is None:
        yield node, at
    elif len(at):
        side = growth.goes_left(rows, at, *split[:2])
        yield from _routed(growth, top, rows, at[side], 2 * node)
        yield from _routed(growth, top, rows, at[~side], 2 * node + 1)


@dataclass
class Nodes:
    """The nodes of all trees of a model, as arrays that go to every task: about 30 bytes a node."""

    root: np.ndarray  # of each tree
    feature: np.ndarray  # -1 for a leaf
    threshold: np.ndarray
    child: np.ndarray  # left and right of node i at 2 * i and 2 * i + 1; of a leaf its row of share
    share: np.ndarray  # of each class, by leaf
    n_features: int

    @classmethod
    def read(cls, path: str) -> Nodes:
        spark, node = SparkSession.active(), F.col("nodeData")
        found = spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), node["id"].alias("at"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            F.when(node["leftChild"] < 0, node["impurityStats"]).alias("counts"),
        ).toArrow()
        size = json.loads(spark.read.text(f"{path}/metadata").first().value)
        tree, at, left, right, feature = (found.column(c).to_numpy() for c in ("tree", "at", "left", "right", "feature"))
        order = np.lexsort((at, tree))
        first = np.append(0, np.cumsum(np.bincount(tree)))
        before, leaf = first[tree[order]], left[order] < 0
        counts = found.column("counts").combine_chunks().take(pa.array(order[leaf])).flatten().to_numpy().reshape(-1, size["numClasses"])
        total = sum(counts.T[1:], counts.T[0])[:, None]
        child = np.stack([before + left[order], before + right[order]], axis=1)
        child[leaf] = np.arange(len(counts))[:, None]
        threshold = found.column("threshold").to_numpy()[order]
        share = np.divide(counts, total, out=np.zeros_like(counts), where=total != 0)
        return cls(first[:-1].astype(np.int32), np.where(leaf, -1, feature[order]).astype(np.int32), threshold, child.ravel().astype(np.int32), share, size["numFeatures"])

    @property
    def depth(self) -> int:
        """Of the deepest tree."""
        depth, level = 0, self.root
        while len(level := level[self.feature[level] >= 0]):
            depth, level = depth + 1, self.child.reshape(-1, 2)[level].ravel()
        return depth

    def votes(self, size: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The shares of each class in the leaves that rows come to, added up tree after tree."""
        found, start = np.empty((len(size), self.share.shape[1])), np.append(0, np.cumsum(size, dtype=np.int64))
        step = min(max(SCORED // (8 * max(self.n_features, 1)), 1), CHUNK_ROWS // 4)
        table = np.zeros((min(step, len(size)), self.n_features))
        for low in range(0, len(size), step):
            some = size[low : low + step]
            cells = slice(start[low], start[low + len(some)])
            of = np.repeat(np.arange(len(some)), some), index[cells]
            table[of] = value[cells]
            at = np.tile(self.root, len(some))
            open_ = np.flatnonzero(self.feature[at] >= 0)
            while len(open_):
                node = at[open_]
                goes_right = ~(table[open_ // len(self.root), self.feature[node]] <= self.threshold[node])
                at[open_] = node = self.child[2 * node + goes_right]
                open_ = open_[self.feature[node] >= 0]
            table[of] = 0.0
            leaves = self.child[2 * at].reshape(len(some), -1)
            total = np.zeros((len(some), found.shape[1]))
            for leaf in leaves.T:
                total += self.share[leaf]
            found[low : low + step] = total
        return found


class ForestModel(RandomForestClassificationModel):
    """Spark's model that is written at ``path``. It scores by arrays of its nodes; the driver loads
    it whole only where something else of it is asked for."""

    def __init__(self, path: str, spec: RandomForestClassifier | RandomForestClassificationModel):
        self.path, self.held = path, {}  # what has been read of it
        super().__init__()
        self._resetUid(spec.uid)
        spec._copyValues(self)

    @classmethod
    def read(cls, path: str) -> ForestModel:
        """A saved model, with the parameters it was saved with."""
        about = json.loads(SparkSession.active().read.text(f"{path}/metadata").first().value)
        spec = RandomForestClassifier()
        spec._resetUid(about["uid"])
        for name, value in about["paramMap"].items():
            spec.set(spec.getParam(name), value)
        return cls(path, spec)

    # Spark reads all attributes of a stage to find its parameters, but for those that are a ``property``.
    @property
    def whole(self) -> RandomForestClassificationModel:
        if "whole" not in self.held:
            self.held["whole"] = RandomForestClassificationModel.load(self.path)
        return self.held["whole"]

    @property
    def trees(self):
        return self.whole.trees

    @property
    def _java_obj(self):
        return self.whole._java_obj

    @_java_obj.setter
    def _java_obj(self, given):
        """Spark's wrappers set it when they are made."""

    def __del__(self):
        """The loaded model lets go of itself."""

    @property
    def nodes(self) -> Nodes:
        if "nodes" not in self.held:
            self.held["nodes"] = Nodes.read(self.path)
        return self.held["nodes"]

    @property
    def shared(self):
        if "shared" not in self.held:
            self.held["shared"] = SparkSession.active().sparkContext.broadcast(self.nodes)
        return self.held["shared"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.isSet(self.thresholds):
            return self.whole.transform(dataset)
        shared, vector = self.shared, F.unwrap_udt(self.getFeaturesCol())

        @F.arrow_udf("array<double>")
        def votes(index: pa.Array, value: pa.Array) -> pa.Array:
            size = value.value_lengths().to_numpy(zero_copy_only=False)
            found = shared.value.votes(size, index.flatten().to_numpy(), value.flatten().to_numpy())
            ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

        cast = votes(_places(vector), vector["values"])
        raw, classes = F.col("_votes"), self.nodes.share.shape[1]
        of = [F.get(raw, F.lit(c)) for c in range(classes)]
        total = sum(of[1:], of[0])
        columns = {
            self.getRawPredictionCol(): array_to_vector(raw),
            self.getProbabilityCol(): array_to_vector(F.array(*[x / total for x in of])),
            self.getPredictionCol(): (F.array_position(raw, F.array_max(raw)) - 1).cast("double"),
        }
        return dataset.withColumn("_votes", cast).withColumns({name: c for name, c in columns.items() if name}).drop("_votes")


def _places(vector: Column) -> Column:
    """The places of a vector's values, all of them for a dense one."""
    all_ = F.when(F.size(vector["values"]) > 0, F.sequence(F.lit(0), F.size(vector["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(vector["indices"].isNull(), all_).otherwise(vector["indices"])


class Forest(Estimator):
    """Fits what ``spec`` describes; rows of a class have one weight. Bags depend on the
    partitions of the rows and their order in them."""

    def __init__(self, spec: RandomForestClassifier, in_task: int | None = None):
        super().__init__()
        self.spec, self.in_task = spec, in_task

    def _fit(self, dataset: DataFrame) -> ForestModel:
        return self.fit_depths(dataset, [self.spec.getMaxDepth()])[0]

    def fit_depths(self, dataset: DataFrame, depths: list[int]) -> list[ForestModel]:
        """The forest of each limit, grown once with the deepest: draws of a node depend on its
        place alone, so a lower limit cuts the same trees off. One that cuts nothing is the same model."""
        path, growth = self._grown(dataset, max(depths))
        deepest = self._model(path, max(depths))
        reached, models = deepest.nodes.depth if len(depths) > 1 else 0, {}
        for depth in depths:
            models[depth] = self._model(self._cut(path, growth, depth), depth) if depth < reached else deepest
        return [models[depth] for depth in depths]

    def _model(self, path: str, depth: int) -> ForestModel:
        return ForestModel(path, self.spec.copy({self.spec.maxDepth: depth}))

    def _grown(self, dataset: DataFrame, max_depth: int) -> tuple[str, Growth]:
        spec, vector = self.spec, F.unwrap_udt(self.spec.getFeaturesCol())
        df = dataset.select(
            F.col(spec.getLabelCol()).cast("int").alias("label"),
            F.col(spec.getWeightCol()).alias("weight"),
            _places(vector).alias("index"),
            vector["values"].alias("value"),
            F.coalesce(vector["size"], F.size(vector["values"])).alias("n"),
        )
        figures = F.count("*").alias("rows"), F.min("weight").alias("w"), F.max("weight").alias("most"), F.max("n").alias("n"), F.sum(F.size("value")).alias("cells")
        by_class = df.groupBy("label").agg(*figures).collect()
        if not by_class:
            raise ValueError("no rows to fit a forest on")
        if max(r.label for r in by_class) > np.iinfo(PACKED["label"]).max:
            raise ValueError("labels above 255")
        if any(r.most - r.w > 1e-9 * r.most for r in by_class):
            raise ValueError("rows of a class have one weight")
        weights = np.zeros(max(r.label for r in by_class) + 1)
        weights[[r.label for r in by_class]] = [r.w for r in by_class]
        total, size = sum(r.rows for r in by_class), max(r.n for r in by_class)
        first, cuts = self._thresholds(df, total, size)
        growth = Growth(len(weights), weights, first, cuts, spec.getNumTrees(), max_depth, spec.getMinInstancesPerNode(), spec.getSeed())
        shared = dataset.sparkSession.sparkContext.broadcast(growth)
        chunks = pin(df.select("label", "index", "value").mapInArrow(_binned(shared), PACKED_DDL), "forest-rows")
        cells = max(sum(r.cells for r in by_class) / total, 1.0)
        tops = self._tops(chunks, growth, shared, self.in_task or min(IN_TASK, int(IN_TASK_CELLS / cells)))
        return self._written(chunks, growth, shared, tops), growth

    def _cut(self, path: str, growth: Growth, max_depth: int) -> str:
        """The forest at ``path`` with a lower limit."""
        names = [x.split()[0] for x in NODE.split(", ")]

        def cut(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
            of, found = {x[0]: x for x in nodes[names].itertuples(index=False, name=None)}, []

            def add(at: int, depth: int) -> int:
                me, (*said, gain, left, right, feature, threshold) = len(found), of[at]
                found.append([me, *said[1:], -1.0, -1, -1, -1, None])
                if left >= 0 and depth < max_depth:
                    left, right = add(left, depth + 1), add(right, depth + 1)
                    found[me][5:] = [gain, left, right, feature, threshold]
                    _merge(found, me)
                return me

            add(0, 0)
            return pd.DataFrame(found, columns=names).assign(tree=key[0])[["tree", *names]]

        node = F.col("nodeData")
        nodes = SparkSession.active().read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), node["id"].alias("at"), node["prediction"].alias("prediction"), node["impurity"].alias("impurity"),
            node["impurityStats"].alias("counts"), node["rawCount"].alias("raw"), node["gain"].alias("gain"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        )
        return self._saved(nodes.groupBy("tree").applyInPandas(cut, f"tree int, {NODE}"), growth, max_depth)

    def _thresholds(self, df: DataFrame, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds of all features, of about ``SAMPLE`` rows where there are more; Spark's fit
        samples as many."""
        some = df if total <= SAMPLE else df.sample(False, SAMPLE / total, self.spec.getSeed())
        weight = some.agg(F.sum("weight")).first()[0] or 0.0
        splits = min(self.spec.getMaxBins(), BINS, total) - 1

        def of_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [[batch.column(c).to_numpy() for c in ("feature", "value", "weight")] for batch in batches]
            if parts:
                feature, value, weights = map(np.concatenate, zip(*parts))
                order = np.argsort(feature, kind="stable")
                features, starts = np.unique(feature[order], return_index=True)
                found = [thresholds(value[at], weights[at], weight, splits) for at in np.split(order, starts[1:])]
                yield pa.record_batch({"feature": pa.array(features, pa.int32()), "cuts": pa.array(found, pa.list_(pa.float64()))})

        cells = some.select("weight", F.inline(F.arrays_zip("index", "value"))).toDF("weight", "feature", "value")
        found = cells.repartition("feature").mapInArrow(of_features, "feature int, cuts array<double>").collect()
        n, each = np.zeros(size, np.int64), {r.feature: r.cuts for r in found if r.cuts}
        for f, cuts in each.items():
            n[f] = len(cuts)
        return np.append(0, np.cumsum(n)), np.array([x for f in sorted(each) for x in each[f]], np.float64)

    def _tops(self, chunks: DataFrame, growth: Growth, shared, in_task: int) -> list[dict[int, Top]]:
        """Split nodes while one has more rows than a task takes."""

        def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            growth = shared.value
            sums = np.zeros((growth.trees, growth.classes + 1), np.int64)
            for rows in _chunks(batches, growth.trees):
                for c in range(growth.classes):
                    sums[:, c] += rows.copies[rows.label == c].sum(axis=0, dtype=np.int64)
                sums[:, -1] += (rows.copies > 0).sum(axis=0)
            yield pa.record_batch({"tree": pa.array(range(growth.trees), pa.int32()), "sums": pa.array(sums.tolist(), pa.list_(pa.int64()))})

        partial = chunks.mapInArrow(roots, "tree int, sums array<long>").select("tree", F.posexplode("sums").alias("at", "n"))
        tops = [{1: Top(np.zeros(growth.classes, np.int64), 0)} for _ in range(growth.trees)]
        for r in partial.groupBy("tree", "at").agg(F.sum("n").alias("n")).collect():
            root = tops[r.tree][1]
            if r.at < growth.classes:
                root.counts[r.at] = r.n
            else:
                root.rows = r.n
        while True:
            for top in tops:
                for node, x in top.items():
                    x.leaf = x.leaf or x.split is None and growth.ends(x.counts, node.bit_length() - 1)
            large = {(t, node) for t, top in enumerate(tops) for node, x in top.items() if x.split is None and not x.leaf and x.rows > in_task}
            if not large:
                return tops
            for r in _best_splits(chunks, shared, tops, large).collect():
                top, x = tops[r.tree], tops[r.tree][r.node]
                if r.feature is None:
                    x.leaf = True
                    continue
                x.split = r.feature, r.bin, r.gain
                left = np.array(r.left)
                top[2 * r.node] = Top(left[:-1], int(left[-1]))
                top[2 * r.node + 1] = Top(x.counts - left[:-1], x.rows - int(left[-1]))

    def _written(self, chunks: DataFrame, growth: Growth, shared, tops: list[dict[int, Top]]) -> str:
        """Grow the subtrees and write them, numbered behind the top of their tree, as Spark does."""
        spark = chunks.sparkSession
        open_ = {(t, node) for t, top in enumerate(tops) for node, x in top.items() if x.split is None and not x.leaf}
        grown, sizes = _subtrees(chunks, shared, tops, open_), {}
        if any(len(top) > 1 for top in tops):  # whole trees need no other numbers
            grown = pin(grown, "forest-nodes")
            sizes = {(r.tree, r.node): r for r in grown.groupBy("tree", "node").agg(F.count("*").alias("n"), F.max_by("prediction", -F.col("at")).alias("prediction")).collect()}
        rows, offsets = [], []
        for t, top in enumerate(tops):
            for node in sorted(top, reverse=True):  # leaves of one prediction become one, from below
                x = top[node]
                if x.split is None:
                    continue
                sides = [2 * node, 2 * node + 1]
                said = [growth.leaf(0, top[s].counts)[1] if top[s].leaf else sizes[t, s].prediction if top[s].split is None and sizes[t, s].n == 1 else None for s in sides]
                if said[0] is not None and said[0] == said[1]:
                    x.split, x.leaf = None, True
                    for s in sides:
                        del top[s]
            inner = [node for node in sorted(top) if top[node].split is not None or top[node].leaf]
            number, upto = {node: i for i, node in enumerate(inner)}, len(inner)
            for node in sorted(set(top) - set(inner)):
                number[node] = upto
                offsets.append((t, node, upto))
                upto += sizes[t, node].n if sizes else 0
            for node in inner:
                x, values = top[node], growth.leaf(number[node], top[node].counts)
                if x.split is not None:
                    f, b, gain = x.split
                    values[5:] = [gain, number[2 * node], number[2 * node + 1], f, float(growth.thresholds[growth.first[f] + b])]
                rows.append((t, *values))
        moved = [F.when(F.col(c) >= 0, F.col(c) + F.col("offset")).otherwise(F.col(c)).alias(c) for c in ("at", "left", "right")]
        places = spark.createDataFrame(offsets, "tree int, node long, offset int")
        below = grown.join(F.broadcast(places), ["tree", "node"]).withColumns({c: m for c, m in zip(("at", "left", "right"), moved)})
        nodes = below.drop("node", "offset").unionByName(spark.createDataFrame(rows, f"tree int, {NODE}"))
        return self._saved(nodes, growth, growth.max_depth)

    def _saved(self, nodes: DataFrame, growth: Growth, max_depth: int) -> str:
        """Write ``(tree, NODE)`` as a model of Spark."""
        spark = nodes.sparkSession
        spec = self.spec.copy({self.spec.maxDepth: max_depth})
        cut = F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>"))
        split = F.struct(F.col("feature").alias("featureIndex"), cut.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
        data = F.struct(
            F.col("at").alias("id"), "prediction", "impurity", F.col("counts").alias("impurityStats"), F.col("raw").alias("rawCount"),
            "gain", F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
        )
        path = shared_folder(spark, "forest")
        nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.parquet(f"{path}/data")
        size = {"numFeatures": growth.n_features, "numClasses": growth.classes}
        given = {p.name: v for p, v in spec.extractParamMap().items() if spec.isSet(p)}
        usual = {p.name: spec.getOrDefault(p) for p in spec.params if spec.hasDefault(p) and not spec.isSet(p)}
        about = {"timestamp": 0, "sparkVersion": spark.version}
        of_tree = [{k: v for k, v in params.items() if k not in ("numTrees", "bootstrap", "subsamplingRate", "featureSubsetStrategy")} for params in (given, usual)]
        tree = about | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", "paramMap": of_tree[0], "defaultParamMap": of_tree[1]}
        trees = [(t, json.dumps(tree | {"uid": f"{spec.uid}_tree_{t}"}), 1.0) for t in range(growth.trees)]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
        whole = about | {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "uid": spec.uid, "paramMap": given, "defaultParamMap": usual, **size, "numTrees": growth.trees}
        spark.range(1).select(F.lit(json.dumps(whole)).alias("value")).coalesce(1).write.text(f"{path}/metadata")
        return path


def _binned(shared):
    """Rows to chunks of bins, with the copies of each row in the bag of each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        growth = shared.value
        rng = np.random.default_rng([growth.seed, TaskContext.get().partitionId()])
        for batch in batches:
            label = batch.column("label").to_numpy()
            size = batch.column("index").value_lengths().to_numpy().astype(np.int32)
            index, value = (batch.column(c).flatten().to_numpy() for c in ("index", "value"))
            bins = growth.bins(index, value)
            rows = Rows(label, label, size, index.astype(np.uint16) if growth.n_features <= 1 << 16 else index, bins)
            at = 0
            while at < len(label):
                end = int(np.searchsorted(rows.start, rows.start[at] + CHUNK_CELLS, "right")) - 1
                end = min(max(end, at + 1), at + CHUNK_ROWS, len(label))
                bag = np.minimum(rng.poisson(1.0, (end - at, growth.trees)), 255)
                chunk = rows.packed(np.arange(at, end), bag)
                yield pa.record_batch({name: pa.array([x], pa.binary()) for name, x in chunk.items()})
                at = end

    return run


def _chunks(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[Rows]:
    for batch in batches:
        for record in batch.to_pylist():
            rows = Rows.unpacked([record])
            rows.copies = rows.copies.reshape(-1, trees)
            yield rows


def _parts(batches, growth: Growth, tops: list[dict[int, Top]], wanted: set[tuple[int, int]]) -> Iterator[tuple[int, int, Rows, np.ndarray, np.ndarray]]:
    """The rows of each chunk that come to a wanted node, with their copies."""
    trees = sorted({t for t, _ in wanted})
    for rows in _chunks(batches, growth.trees):
        rows.table(growth.zero_bin)
        for t in trees:
            copies = np.ascontiguousarray(rows.copies[:, t])
            for node, at in _routed(growth, tops[t], rows, np.flatnonzero(copies)):
                if len(at) and (t, node) in wanted:
                    yield t, node, rows, at, copies[at]


def _best_splits(chunks: DataFrame, shared, tops: list[dict[int, Top]], wanted: set[tuple[int, int]]) -> DataFrame:
    """``(tree, node, feature, bin, gain, left)`` of nodes too large for a task."""
    state = chunks.sparkSession.sparkContext.broadcast((tops, wanted))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        growth, (tops, wanted) = shared.value, state.value
        sums: dict[tuple[int, int], np.ndarray] = {}

        def out() -> pa.RecordBatch:
            keys = list(sums)
            columns = [pa.array([t for t, _ in keys], pa.int32()), pa.array([n for _, n in keys], pa.int64()), pa.array([sums[k].tobytes() for k in keys], pa.binary())]
            return pa.record_batch(columns, ["tree", "node", "found"])

        held = 0
        for t, node, rows, at, copies in _parts(batches, growth, tops, wanted):
            found = growth.histogram(rows, at, copies, growth.drawn(t, node))
            if (t, node) in sums:
                sums[t, node] += found
                continue
            sums[t, node] = found
            held += found.nbytes
            if held > 1 << 27:
                yield out()
                sums, held = {}, 0
        if sums:
            yield out()

    def best(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        growth, features = shared.value, shared.value.drawn(*map(int, key))
        found = sum(np.frombuffer(x, np.int64) for x in parts["found"]).reshape(len(features), BINS, -1)
        split = growth.best(found, features)
        row = [*key, None, None, None, None] if split is None else [*key, int(features[split[0]]), split[1], split[2], found[split[0], : split[1] + 1].sum(axis=0).tolist()]
        return pd.DataFrame([row], columns=["tree", "node", "feature", "bin", "gain", "left"], dtype=object)

    counted = chunks.mapInArrow(count, "tree int, node long, found binary")
    return counted.groupBy("tree", "node").applyInPandas(best, "tree int, node long, feature int, bin int, gain double, left array<long>")


def _subtrees(chunks: DataFrame, shared, tops: list[dict[int, Top]], wanted: set[tuple[int, int]]) -> DataFrame:
    """The nodes from each wanted one downwards; its rows, which a task takes, meet in one task.

    Trees that a task grows from the root come ``TOGETHER``, so that a row is sent once for them."""
    state = chunks.sparkSession.sparkContext.broadcast((tops, wanted))

    below = {(t, node) for t, node in wanted if node > 1}
    whole = sorted({t - t % TOGETHER for t, node in wanted if node == 1})
    number = {key: i for i, key in enumerate([*sorted(below), *((t, 1) for t in whole)])}  # a task each, or more to one task
    n_parts = min(max(len(number), 1), 1 << 12)

    def record(tree: int, node: int, packed: dict[str, bytes]) -> pa.RecordBatch:
        columns = {name: pa.array([x], pa.binary()) for name, x in packed.items()}
        return pa.record_batch({"part": pa.array([number[tree, node]], pa.int32()), "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), **columns})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        growth, (tops, wanted) = shared.value, state.value
        for batch in batches:
            for rows in _chunks([batch], growth.trees) if whole else ():
                for tree in whole:
                    copies = rows.copies[:, tree : tree + TOGETHER]
                    at = np.flatnonzero(copies.any(axis=1))
                    if len(at):
                        yield record(tree, 1, rows.packed(at, copies[at]))
            for t, node, rows, at, copies in _parts([batch], growth, tops, below) if below else ():
                yield record(t, node, rows.packed(at, copies))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        growth, wanted = shared.value, state.value[1]
        records = (record for batch in batches for i in range(batch.num_rows) for record in batch.slice(i, 1).to_pylist())
        for _, parts in groupby(records, key=lambda r: r["part"]):
            parts = list(parts)
            tree, node, rows = parts[0]["tree"], parts[0]["node"], Rows.unpacked(parts)
            del parts
            trees = range(tree, min(tree + TOGETHER, growth.trees)) if node == 1 else [tree]
            for t, copies in zip(trees, np.ascontiguousarray(rows.copies.reshape(-1, len(trees)).T)):
                if (t, node) in wanted:
                    rows.copies = copies
                    found = zip(*([t, node, *x] for x in growth.grown(rows, t, node)))
                    yield pa.record_batch([pa.array(x, kind.type) for x, kind in zip(found, schema)], schema=schema)

    schema = pa.schema([("tree", pa.int32()), ("node", pa.int64()), *((name, NODE_TYPES[kind]) for name, kind in (x.split() for x in NODE.split(", ")))])
    dealt = chunks.mapInArrow(deal, f"part int, tree int, node long, {PACKED_DDL}").repartitionById(n_parts, F.pmod("part", F.lit(n_parts)))
    if len(number) > n_parts:
        dealt = dealt.sortWithinPartitions("part")
    return dealt.mapInArrow(grow, f"tree int, node long, {NODE}")
