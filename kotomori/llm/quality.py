"""Quality classifier over random-indexing word vectors.

Every token has a sparse random index vector (one signed entry in ``dims``, from its
hash). The vector of a token class is the sum of the index vectors of its neighbours over
the whole corpus, scaled to length one; token classes are hash buckets of tokens, so the
table has ``classes`` rows whatever the input. A document is the mean of the vectors of
its tokens, their spread, and the mean of its own neighbour vectors, which tells how a
text combines its words apart from which words they are.

A network with one hidden layer, in numpy, is fitted to a bounded sample of labelled
documents and its temperature to others of them, so that scores are probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kotomori.llm.common import is_held_out, labelled_sample, register, slices, table, texts
from kotomori.session import pin

TOKEN = re.compile(r"\w+|[^\w\s]+|\n")


@dataclass(frozen=True)
class QualitySettings:
    #: Token classes and dimensions of their vectors.
    classes: int = 4096
    dims: int = 32
    #: Neighbours on each side.
    window: int = 2
    #: Labelled documents used to fit, at most: those with the smallest hashes.
    sample: int = 20_000
    #: Share of them that fits the temperature.
    calibrating: float = 0.2
    hidden: int = 24
    epochs: int = 60
    batch: int = 128
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 10
    #: Tokens whose class a task remembers.
    remembered: int = 200_000


class Tokens(dict):
    """Token -> its hash; starts afresh when full."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def __missing__(self, token: str) -> int:
        value = zlib.crc32(token.encode())
        if len(self) >= self.limit:
            self.clear()
        if len(token) < 64:
            self[token] = value
        return value

    def of(self, text: str) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, TOKEN.findall(text)), dtype=np.uint32)


def indexed(hashes: np.ndarray, settings: QualitySettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, index dimension and sign of each token, from different bits of its hash."""
    mixed = (hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    dim = (mixed % np.uint64(settings.dims)).astype(np.int64)
    sign = 1.0 - 2.0 * ((mixed >> np.uint64(20)) & np.uint64(1)).astype(np.float64)
    return (hashes % settings.classes).astype(np.int64), dim, sign


def neighbours(docs: list[np.ndarray], rows: list[np.ndarray], n_rows: int, settings: QualitySettings) -> np.ndarray:
    """Sum of the index vectors of all neighbours, into the row given for each token."""
    total = np.zeros(n_rows * settings.dims)
    hashes, row = np.concatenate(docs), np.concatenate(rows)
    _, dim, sign = indexed(hashes, settings)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    for step in range(1, settings.window + 1):
        same = owner[step:] == owner[:-step]
        for centre, other in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
            at = row[centre][same] * settings.dims + dim[other][same]
            total += np.bincount(at, weights=sign[other][same], minlength=len(total))
    return total.reshape(n_rows, settings.dims)


def token_vectors(docs: DataFrame, settings: QualitySettings) -> np.ndarray:
    """Vectors of all token classes, from all texts; ``classes`` x ``dims`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = np.zeros((settings.classes, settings.dims)), Tokens(settings.remembered)
        for _, part in slices(batches):
            hashes = [tokens.of(t) for t in part]
            total += neighbours(hashes, [indexed(h, settings)[0] for h in hashes], settings.classes, settings)
        used = np.flatnonzero(total.any(axis=1))
        for k in range(0, len(used), 1024):
            at = used[k : k + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(list(total[at]), pa.list_(pa.float64()))], ["class", "v"])

    sums = docs.select("text").mapInArrow(run, "class int, v array<double>").groupBy("class")
    rows = sums.agg(F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(settings.dims)]).alias("v")).collect()  # one row per class
    vectors = np.zeros((settings.classes, settings.dims))
    for r in rows:
        vectors[r["class"]] = r.v
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def pooled(texts_: list[str], tokens: Tokens, vectors: np.ndarray, settings: QualitySettings) -> np.ndarray:
    """A row of features for each text; zeros for one without tokens."""
    dims = settings.dims
    out = np.zeros((len(texts_), 3 * dims + 2))
    hashes = [tokens.of(t) for t in texts_]
    filled = [i for i, h in enumerate(hashes) if len(h)]
    if not filled:
        return out
    docs = [hashes[i] for i in filled]
    sizes = np.array([len(d) for d in docs])
    # Vectors are looked up once for each class of a document, of which there are at most ``classes``.
    owner = np.repeat(np.arange(len(docs)), sizes)
    cells, counts = np.unique(owner * settings.classes + indexed(np.concatenate(docs), settings)[0], return_counts=True)
    starts = np.searchsorted(cells, np.arange(len(docs)) * settings.classes)
    v, share = vectors[cells % settings.classes], (counts / sizes[cells // settings.classes])[:, None]
    mean = np.add.reduceat(v * share, starts)
    spread = np.sqrt(np.maximum(np.add.reduceat(v * v * share, starts) - mean**2, 0))
    own = neighbours(docs, [np.full(len(d), i) for i, d in enumerate(docs)], len(docs), settings) / sizes[:, None]
    distinct = np.array([len(np.unique(d)) for d in docs]) / sizes
    out[filled] = np.hstack([mean, spread, own, distinct[:, None], np.log1p(sizes)[:, None]])
    return out


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, settings: QualitySettings) -> Network:
    """Adam on the cross entropy, then a temperature on the rows kept back."""
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(x))
    n_back = int(len(x) * settings.calibrating)
    back, used = order[:n_back], order[n_back:]
    mean, scale = x[used].mean(axis=0), np.maximum(x[used].std(axis=0), 1e-6)
    net = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], settings.hidden)), np.zeros(settings.hidden), rng.normal(0, settings.hidden**-0.5, settings.hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    z, t, step = np.clip((x - mean) / scale, -8, 8), y.astype(float), 0
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        shuffled = rng.permutation(used)
        for k in range(0, len(shuffled), settings.batch):
            b = shuffled[k : k + settings.batch]
            h = np.tanh(z[b] @ net[0] + net[1])
            error = (sigmoid(h @ net[2] + net[3][0]) - t[b]) / len(b)
            back_h = np.outer(error, net[2]) * (1 - h * h)
            grads = [z[b].T @ back_h, back_h.sum(axis=0), h.T @ error, np.array([error.sum()])]
            step += 1
            for i, g in enumerate(grads):
                g = g + settings.decay * net[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                net[i] = net[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, net[0], net[1], net[2], float(net[3][0]))
    if len(back) and len(set(y[back].tolist())) == 2:
        logits, want = network.logits(x[back]), t[back]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
        loss = [-np.mean(np.log(np.maximum(np.where(want == 1, sigmoid(logits / g), 1 - sigmoid(logits / g)), 1e-12))) for g in grid]
        network = Network(mean, scale, net[0], net[1], net[2], float(net[3][0]), float(grid[int(np.argmin(loss))]))
    return network


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    network: Network | None
    share: float  # of label 1, the score where nothing can be learnt


def fit_quality(docs: DataFrame, labels: DataFrame, settings: QualitySettings, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Vectors from all ``docs``, the network from a sample of labelled ones.

    Labels that are null or not 0 or 1 are left out, and so are those of held-out
    documents. Without documents of both labels the score is the share of label 1, or
    0.5 without any.
    """
    rows = texts(docs, key, text)
    vectors = token_vectors(rows, settings)
    sample = labelled_sample(rows, labels, key, label, settings.sample, settings.seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(settings.remembered)
        for batch, part in slices(batches):
            x = pooled(part, tokens, vectors, settings)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["key", "label", "x"])

    kind = dict(rows.dtypes)["key"]
    got = pin(sample.select("key", "label", "text").mapInArrow(run, f"key {kind}, label int, x array<double>"), "quality-sample").orderBy("key", "x").collect()  # at most ``sample`` rows
    y = np.array([r.label for r in got], dtype=int)
    if len(set(y.tolist())) < 2:
        return QualityModel(vectors, None, float(y.mean()) if len(y) else 0.5)
    return QualityModel(vectors, fit_network(np.array([r.x for r in got]), y, settings), float(y.mean()))


def score_quality(docs: DataFrame, model: QualityModel, settings: QualitySettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a last column ``score``: the probability of label 1.

    A null or empty text is scored like one without tokens. All rows stay, and all columns but an older ``score``.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    column, out = text, "score"
    fields = [f for f in docs.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokens = held.value, Tokens(settings.remembered)
        for batch, part in slices(batches, column):
            if model.network is None:
                scores = np.full(len(part), model.share)
            else:
                scores = model.network.scores(pooled([t or "" for t in part], tokens, model.vectors, settings))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, out])

    kept = docs.select(*[f"`{f.name}`" for f in fields])
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(out, DoubleType())]))


def with_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: QualitySettings) -> DataFrame:
    return score_quality(docs, fit_quality(docs, labels, settings), settings)


@register("op10_quality")
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = with_quality(spark, docs, table(spark, sf, "labels"), QualitySettings())
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
