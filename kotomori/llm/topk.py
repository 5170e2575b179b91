"""Exact top-k search by tiled integer inner products.

Candidates are dealt into shards and queries into tiles. A task multiplies one tile by
one shard, a sub-matrix at a time, and keeps the best ``k`` of each query in the shard
(partial selection by the k-th score, ties by id). The lists of a query are then merged
``fan`` at a time, level by level, so that no task sees more than ``fan`` lists a query.

Every shard is sent to every tile, so matrices travel as the shortest whole numbers that
hold their components, and a tile is as large as a shard. Scores are whole numbers. Matrix products in double precision are exact while no sum can
reach 2^53, which is checked for each product; beyond that the product is made with
Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, table
from kotomori.session import pin


@dataclass(frozen=True)
class SearchSettings:
    k: int = 20
    #: Components in a tile of queries and in a shard of candidates, on average.
    tile: int = 1 << 19
    shard: int = 1 << 19
    #: Queries and candidates multiplied at a time.
    rows: int = 1024
    block: int = 2048
    #: Lists of a query that are merged at a time.
    fan: int = 8


LISTS = "tile int, shard int, query binary, query_id binary, vec_id binary, vec binary, score binary"
LOW, HIGH = 1 - (1 << 63), (1 << 63) - 1


def best_of_block(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Mask of the ``k`` best columns of each row that ``own`` does not exclude; of
    equal scores the first columns."""
    usable = ~own
    if scores.shape[1] <= k:
        return usable
    lowest = scores.min() if scores.dtype == object else -np.inf
    masked = np.where(own, lowest, scores)
    # With at most one column of a row excluded, the k-th of the rest is at or above this one.
    if scores.dtype == object:
        kth = np.sort(masked, axis=1)[:, [-k]]
    else:
        kth = np.partition(masked, -k, axis=1)[:, [-k]]
    above = usable & (scores > kth)
    equal = usable & (scores == kth)
    room = k - above.sum(axis=1, keepdims=True)
    return above | (equal & (np.cumsum(equal, axis=1) <= room))


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < 2.0**53:
        return a @ b.T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, LOW, HIGH)


def keep_best(query: np.ndarray, ids: np.ndarray, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each query: higher scores first, then smaller ids."""
    order = np.lexsort((rows, ids, -score, query))
    q = query[order]
    first = np.r_[True, q[1:] != q[:-1]]
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return order[rank < k]


def lists_row(tile: int, shard: int, query, query_id, ids, rows, score) -> dict:
    return {"tile": tile, "shard": shard, "query": query.tobytes(), "query_id": query_id.tobytes(), "vec_id": ids.tobytes(), "vec": rows.tobytes(), "score": score.tobytes()}


def arrays_of(row) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(x, dtype="<i8") for x in (row.query, row.query_id, row.vec_id, row.vec, row.score))


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The whole numbers of ``matrix`` in the shortest type that holds them all."""
    reach = np.abs(matrix).max(initial=0)
    return matrix.astype(next((t for t in ("<i1", "<i2", "<i4") if reach <= np.iinfo(t).max), "<f8"))


def wide(matrix: bytes, n: int, width: int) -> np.ndarray:
    """What ``narrow`` was given, of ``n`` rows: the size of an entry tells its type."""
    kind = {1: "<i1", 2: "<i2", 4: "<i4"}.get(len(matrix) // max(1, n * width), "<f8")
    return np.frombuffer(matrix, dtype=kind).reshape(n, width).astype(np.float64)


def packed(vectors: DataFrame, group: str, width: int) -> DataFrame:
    """``(group, ids, rows, matrix)``: the vectors of each group, by id, as one matrix."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "row"])
        matrix = np.zeros((len(part), width))
        for i, v in enumerate(part["v"]):
            matrix[i, : len(v)] = v
        return pd.DataFrame({group: [part[group].iloc[0]], "ids": [part["id"].to_numpy("<i8").tobytes()], "rows": [part["row"].to_numpy("<i8").tobytes()], "matrix": [narrow(matrix).tobytes()]})

    return vectors.groupBy(group).applyInPandas(pack, f"{group} int, ids binary, rows binary, matrix binary")


def top_k(vectors: DataFrame, is_query: Column, settings: SearchSettings, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best candidates of each query.

    Components become ``floor(64 * x)``. Vectors that are null or hold a null or a
    non-finite component take no part, nor do rows with a null id; a shorter vector counts
    as if it ended in zeros. Each row is a candidate for all queries but itself: rows that
    repeat an id find each other. Scores outside 64 bits are held to their limits. Fewer
    than ``k`` candidates give all of them, no candidates no rows.
    """
    component = F.col(f"`{vector}`").cast("array<double>")
    sound = F.coalesce(F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.where(sound & F.col(f"`{key}`").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"),
        is_query.alias("is_query"),
        F.transform(component, lambda x: F.floor(x * 64).cast("double")).alias("v"),
    )
    rows = pin(rows, "vectors")
    n, n_queries, width = rows.agg(F.count("*"), F.count_if("is_query"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    cells = max(1, width)
    n_shards, n_tiles = max(1, -(-n * cells // settings.shard)), max(1, -(-n_queries * cells // settings.tile))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    shards = packed(rows.withColumn("shard", deal(n_shards)), "shard", width)
    tiles = packed(rows.where("is_query").withColumn("tile", deal(n_tiles)), "tile", width)
    # Every shard meets every tile: each is sent once for each of the others, so that a pair
    # has a key of its own and no task holds more than its share of the pairs.
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = tiles.select("tile", each(n_shards).alias("shard"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("matrix").alias("q_matrix"))
    pairs = shards.withColumn("tile", each(n_tiles)).join(queries, ["tile", "shard"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, places, q_ids, q_places = (np.frombuffer(x, dtype="<i8") for x in (r.ids, r.rows, r.q_ids, r.q_rows))
                a, b = wide(r.q_matrix, len(q_ids), width), wide(r.matrix, len(ids), width)
                kept = []
                for first in range(0, len(q_ids), settings.rows):
                    mine = slice(first, first + settings.rows)
                    held = [np.empty(0, np.int64)] * 4
                    for start in range(0, len(ids), settings.block):
                        part = slice(start, start + settings.block)
                        scores = multiply(a[mine], b[part])
                        q, c = np.nonzero(best_of_block(scores, q_places[mine, None] == places[None, part], settings.k))
                        found = (q + first, ids[part][c], places[part][c], scores[q, c].astype(np.int64))
                        held = [np.concatenate(x) for x in zip(held, found)]
                        best = keep_best(*held, settings.k)
                        held = [x[best] for x in held]
                    kept.append(held)
                q, found_ids, found_rows, score = (np.concatenate(x) for x in zip(*kept))
                yield pd.DataFrame([lists_row(r.tile, r.shard, q_places[q], q_ids[q], found_ids, found_rows, score)])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        query, query_id, ids, rows_, score = (np.concatenate(x) for x in zip(*(arrays_of(r) for r in part.itertuples())))
        best = keep_best(query, ids, rows_, score, settings.k)
        return pd.DataFrame([lists_row(part["tile"].iloc[0], part["shard"].iloc[0] // settings.fan, *(x[best] for x in (query, query_id, ids, rows_, score)))])

    lists = pairs.mapInPandas(search, LISTS)
    while n_shards > 1:
        lists = lists.groupBy("tile", F.floor(F.col("shard") / settings.fan).alias("group")).applyInPandas(merge, LISTS)
        n_shards = -(-n_shards // settings.fan)

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                query, query_id, ids, _, score = arrays_of(r)
                first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.empty(0, bool)
                at = np.arange(len(query))
                rank = at - np.maximum.accumulate(np.where(first, at, 0)) + 1
                yield pd.DataFrame({"query_id": query_id, "rank": rank.astype(np.int32), "vec_id": ids, "score": score})

    return lists.mapInPandas(ranked, "query_id long, rank int, vec_id long, score long")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@register("op9_exact_top_k", OP9_SQL)
def op9_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, SearchSettings())
