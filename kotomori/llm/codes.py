"""Product codes of vectors, exact in whole numbers.

Vectors are cut into equal parts; each part position has a codebook, refined by rounds of
nearest entry and mean. The rows a task scans are packed in chunks. Within a chunk the
parts of one position are sorted along a Hilbert curve and cut into flat blocks, which
keep a box (least and greatest components), the component sums and their points. In every
round the distances from an entry to the nearest and the farthest corner of a box tell
which entries can be nearest to any of its points: those no farther away than the
smallest farthest corner. A block with one such entry adds its stored sums without a look
at its points; the others compare their points with the short list alone.

Chunks are written once and read in each round. Nothing but one row of sums for each task,
position and entry leaves a round, and no vector is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, table
from kotomori.session import pin


@dataclass(frozen=True)
class CodeSettings:
    scale: int = 256
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    #: Vectors in a chunk, and points in a block.
    chunk: int = 1 << 16
    block: int = 128
    #: Components are held to this many either way, so that differences fit in 64 bits.
    reach: int = 1 << 31
    #: Copies of the sums of labels, for the join with rows of which many have one label.
    salts: int = 16


# ---- Hilbert order ------------------------------------------------------------


def hilbert_ranks(points: np.ndarray) -> np.ndarray:
    """Places along a Hilbert curve of whole-number points ``(n, width)``.

    Components are scaled to as many bits as fit in 62 together (8 at most); beyond 62
    components the first 62 decide. Based on the bitwise transform of axes to curve
    coordinates (inverse undo of exchanges and inversions, then Gray coding).
    """
    points = points[:, :62].astype(np.float64)
    n, width = points.shape
    bits = max(1, min(8, 62 // width))
    low = points.min(axis=0)
    span = np.maximum(points.max(axis=0) - low, 1.0)
    x = [c.copy() for c in np.minimum((points - low) / span * (1 << bits), (1 << bits) - 1).astype(np.int64).T]
    for level in range(bits - 1, 0, -1):
        q, below = 1 << level, (1 << level) - 1
        for i in range(width):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(set_, below, 0) ^ swap
            x[i] ^= swap
    for i in range(1, width):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    rank = np.zeros(n, dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(width):
            rank = (rank << 1) | (((x[i] ^ turn) >> level) & 1)
    return rank


# ---- blocks -------------------------------------------------------------------

CHUNK = "n int, width int, cell int, points binary, places binary, low binary, high binary, sums binary"


def packed(vectors: np.ndarray, settings: CodeSettings) -> dict:
    """The blocks of a chunk, all positions in one row. ``vectors``: ``(n, parts * width)``."""
    n, width = len(vectors), vectors.shape[1] // settings.parts
    starts = np.arange(0, n, settings.block)
    most = int(np.abs(vectors).max(initial=0))
    cell = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    points, places, low, high, sums = [], [], [], [], []
    for p in range(settings.parts):
        part = vectors[:, p * width : (p + 1) * width]
        order = np.argsort(hilbert_ranks(part), kind="stable")
        part = part[order]
        points.append(part.astype(f"<i{cell}"))
        places.append(order.astype("<u4"))
        low.append(np.minimum.reduceat(part, starts))
        high.append(np.maximum.reduceat(part, starts))
        sums.append(np.add.reduceat(part, starts))
    join = lambda arrays: b"".join(a.tobytes() for a in arrays)
    return {"n": n, "width": width, "cell": cell, "points": join(points), "places": join(places), "low": join(low), "high": join(high), "sums": join(sums)}


class Chunk:
    """A written chunk: ``points[p]`` are the sorted parts of position ``p``."""

    def __init__(self, row: dict, settings: CodeSettings):
        n, width, p = row["n"], row["width"], settings.parts
        self.n, self.width, self.block = n, width, settings.block
        self.points = np.frombuffer(row["points"], f"<i{row['cell']}").reshape(p, n, width)
        self.places = np.frombuffer(row["places"], "<u4").reshape(p, n)
        box = lambda name: np.frombuffer(row[name], "<i8").reshape(p, -1, width)
        self.low, self.high, self.sums = box("low"), box("high"), box("sums")

    def short_listed(self, p: int, entries: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """The points of each block of position ``p`` and the entries that may be nearest."""
        possible = short_lists(self.low[p], self.high[p], entries)
        for start, row in zip(range(0, self.n, self.block), possible):
            yield slice(start, min(start + self.block, self.n)), np.flatnonzero(row)


def short_lists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """``(blocks, entries)``: may the entry be nearest to a point of the block?"""
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(entries - low[:, None, :], high[:, None, :] - entries)
    if near.dtype != object and 4 * float(max(np.abs(near).max(initial=0), np.abs(far).max(initial=0))) ** 2 * low.shape[1] >= 2.0**63:
        near, far = near.astype(object), far.astype(object)
    return (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1, keepdims=True)


class Kernel:
    """Exact distances of points to the entries of one position's codebook.

    Products of doubles are exact while nothing reaches 2^53; beyond that they are made
    with 64-bit or, at last, Python's integers.
    """

    def __init__(self, points: np.ndarray, entries: np.ndarray):
        most = max(float(np.abs(a.astype(np.float64)).max(initial=0)) for a in (points, entries))
        reach = 4 * most * most * max(1, entries.shape[1])
        kind = np.float64 if reach < 2.0**53 else np.int64 if reach < 2.0**63 else object
        self.points, self.entries = points.astype(np.int64).astype(kind), entries.astype(kind)
        self.norms = (self.entries * self.entries).sum(axis=1)

    def nearest(self, at: slice, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of a few entries for each point, of equal ones the first, and the distance."""
        points = self.points[at]
        score = self.norms[few] - 2 * (points @ self.entries[few].T)
        best = score.argmin(axis=1)
        return few[best], score[np.arange(len(points)), best] + (points * points).sum(axis=1)


def sums_of(chunk: Chunk, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and component sums of each position's entries."""
    counts = np.zeros(books.shape[:2], dtype=np.int64)
    sums = np.zeros(books.shape, dtype=np.int64)
    for p, entries in enumerate(books):
        kernel, best = Kernel(chunk.points[p], entries), np.full(chunk.n, -1)
        for b, (at, few) in enumerate(chunk.short_listed(p, entries)):
            if len(few) == 1:  # all points of the block: its sums are known
                counts[p, few[0]] += at.stop - at.start
                sums[p, few[0]] += chunk.sums[p, b]
            else:
                best[at] = kernel.nearest(at, few)[0]
        open_ = best >= 0
        points, best = chunk.points[p][open_], best[open_]
        counts[p] += np.bincount(best, minlength=len(entries))
        for w in range(chunk.width):  # below 2^53: a chunk's sum of numbers below 2^32
            sums[p, :, w] += np.bincount(best, points[:, w].astype(np.float64), len(entries)).astype(np.int64)
    return counts, sums


def codes_of(chunk: Chunk, books: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Codes ``(n, parts)`` and whole errors of a chunk's vectors, in their own order."""
    codes = np.empty((chunk.n, len(books)), dtype=np.uint8)
    far = max(float(np.abs(a).max(initial=0)) for a in (chunk.low, chunk.high, books))
    errors = np.zeros(chunk.n, dtype=np.int64 if 4 * far * far * chunk.width * len(books) < 2.0**63 else object)
    for p, entries in enumerate(books):
        kernel, best, distance = Kernel(chunk.points[p], entries), np.empty(chunk.n, np.uint8), np.empty(chunk.n, errors.dtype)
        for at, few in chunk.short_listed(p, entries):
            best[at], distance[at] = kernel.nearest(at, few)
        codes[chunk.places[p], p] = best
        errors[chunk.places[p]] += distance
    most = (1 << 63) - 1
    return codes, [min(int(e), most) for e in errors.tolist()]


# ---- the operator ---------------------------------------------------------------


def whole_numbers(column: pa.Array, length: int, settings: CodeSettings) -> np.ndarray:
    """``floor(scale * x)`` of an Arrow list column, as ``(rows, length)``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != length).any():
        raise ValueError(f"vectors of {length} and of {int(lengths[lengths != length][0])} components")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
    return np.clip(np.floor(flat * settings.scale), -float(settings.reach), float(settings.reach)).astype(np.int64)


def chunks(rows: DataFrame, length: int, settings: CodeSettings) -> DataFrame:
    """Rows ``(key, label, v)`` packed in chunks, in the tasks that scan them."""
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(n: int) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            part = whole.slice(0, n).combine_chunks()
            held[:] = whole.slice(n).to_batches()
            row = packed(whole_numbers(part.column("v").combine_chunks(), length, settings), settings)
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(c).combine_chunks()) for c in ("key", "label")]
            types = [pa.int32()] * 3 + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([*lists, *(pa.array([v], t) for v, t in zip(row.values(), types))], ["keys", "labels", *row])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= settings.chunk:
                yield flush(settings.chunk)
        rest = sum(b.num_rows for b in held)
        if rest:
            yield flush(rest)

    return rows.mapInArrow(run, f"keys array<{kinds['key']}>, labels array<{kinds['label']}>, {CHUNK}")


def chunk_rows(batches: Iterator[pa.RecordBatch], settings: CodeSettings) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    names = [c.split()[0] for c in CHUNK.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield row, Chunk({c: row.column(c)[0].as_py() for c in names}, settings)


def refined(blocks: DataFrame, books: np.ndarray, settings: CodeSettings) -> np.ndarray:
    """Codebooks after one round; entries that no part is nearest to stay."""
    held = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        counts, sums = np.zeros(books.shape[:2], dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for _, chunk in chunk_rows(batches, settings):
            more, add = sums_of(chunk, books)
            counts, sums = counts + more, sums + add
        p, e, w = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in (p, e, w)), pa.array(counts[p, e]), pa.array(sums[p, e, w])], ["p", "e", "w", "n", "total"])

    found = blocks.select(*[c.split()[0] for c in CHUNK.split(", ")]).mapInArrow(run, "p int, e int, w int, n long, total long")
    new = books.copy()
    for r in found.groupBy("p", "e", "w").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # a row for each number of the codebooks
        new[r.p, r.e, r.w] = r.total // r.n
    return new


def coded(blocks: DataFrame, books: np.ndarray, settings: CodeSettings) -> DataFrame:
    """``(key, label, code, error)`` of every packed vector."""
    held = blocks.sparkSession.sparkContext.broadcast(books)
    kinds = dict(blocks.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in chunk_rows(batches, settings):
            codes, errors = codes_of(chunk, held.value)
            digits, wide = codes.tobytes().hex(), 2 * settings.parts
            texts = [digits[i : i + wide] for i in range(0, len(digits), wide)]
            yield pa.RecordBatch.from_arrays([row.column("keys").flatten(), row.column("labels").flatten(), pa.array(texts, pa.string()), pa.array(errors, pa.int64())], ["key", "label", "code", "error"])

    return blocks.mapInArrow(run, f"key {kinds['keys'][6:-1]}, label {kinds['labels'][6:-1]}, code string, error long")


def vector_codes(vectors: DataFrame, settings: CodeSettings, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``(key, code, error, label_error)`` of the sound vectors, and the codebooks
    ``(parts, entries, width)``.

    Components become ``floor(scale * x)``. Rows whose vector is null or holds a null or a
    non-finite component go. Codebooks start as the parts of the ``entries`` rows with the
    smallest keys (all rows, if there are fewer; null keys last, equal keys by their
    vectors). Repeated rows and null keys keep a row each. ``label_error`` sums the errors
    of a label's rows; null labels are one label. An empty table gives no rows and empty
    codebooks. Components beyond ``reach`` count as ``reach`` and sums of errors beyond 64
    bits as the greatest number. Vectors of several lengths, or of a length that ``parts``
    does not divide, are an error. Other columns are not read.
    """
    component = F.col(f"`{vector}`").cast("array<double>")
    sound = F.coalesce(F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.where(sound).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), component.alias("v"))
    first = rows.select("key", "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(settings.entries).collect()
    length = len(first[0].v) if first else 0
    if length % settings.parts or (first and not length):
        raise ValueError(f"vectors of {length} components have no {settings.parts} equal parts")
    whole = whole_numbers(pa.array([r.v for r in first], pa.list_(pa.float64())), length, settings) if first else np.empty((0, 0), np.int64)
    books = np.ascontiguousarray(whole.reshape(len(first), settings.parts, length // settings.parts).transpose(1, 0, 2))
    blocks = pin(chunks(rows, length, settings), "vector-blocks")
    for _ in range(settings.rounds if first else 0):
        books = refined(blocks, books, settings)
    codes = pin(coded(blocks, books, settings), "vector-codes")
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # many rows may have one label: its sum is there once for each salt
    salted = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))))
    rows = codes.withColumn("_salt", F.pmod(F.xxhash64("key", "code"), F.lit(settings.salts)).cast("int"))
    joined = rows.join(salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("_salt") == F.col("salt")))
    return joined.select(F.col("key").alias(key), "code", "error", "label_error"), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of the decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _sql(rounds: int = 2, parts: int = 16, entries: int = 64, scale: int = 256) -> str:
    """Every part against every entry of its position, round by round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT p.row, p.part, min(struct_pack(d := list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := b.e)) AS best
  FROM pieces p JOIN book{r} b USING (part) GROUP BY p.row, p.part)""")
        if r < rounds:
            steps.append(f"""means{r} AS (
  SELECT part, best.e AS e, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
  FROM (SELECT n.part, n.best, unnest(p.v) AS x, unnest(range(len(p.v))) AS place FROM near{r} n JOIN pieces p USING (row, part))
  GROUP BY part, best.e, place),
book{r + 1} AS MATERIALIZED (
  SELECT part, e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (SELECT part, e, list(x ORDER BY place) AS v FROM means{r} GROUP BY part, e) m USING (part, e))""")
    return f"""
WITH sound AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT row, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS v
  FROM sound, range({parts}) t(part)),
book0 AS (SELECT part, row - 1 AS e, v FROM pieces WHERE row <= {entries}),
{", ".join(steps)},
digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, e, place)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(v) AS x, unnest(range(len(v))) AS place FROM book{rounds})),
coded AS (
  SELECT row, string_agg(lpad(lower(hex(best.e::BIGINT)), 2, '0'), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM near{rounds} GROUP BY row)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM sound JOIN coded USING (row), digest
"""


@register("op11_vector_codes", _sql())
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf, "embeddings"), CodeSettings())
    return codes.withColumn("codebooks_sha256", F.lit(books_digest(books)))

