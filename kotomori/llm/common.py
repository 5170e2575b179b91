"""What the operators of this subpackage share: the query registry and small readers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Characters of text that a task turns into Python strings at a time.
SLICE_CHARS = 1_000_000


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` of every row, under the given names; a missing text is empty."""
    return df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches so that a slice holds ``SLICE_CHARS`` bytes or one row."""
    for batch in batches:
        array = batch.column(column)
        sizes = [len(s) if s is not None else 0 for s in array.cast(pa.large_binary()).to_pylist()] if array.nbytes > SLICE_CHARS else None
        if sizes is None:
            yield batch, array.to_pylist()
            continue
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > SLICE_CHARS:
                part = batch.slice(start, i - start)
                yield part, part.column(column).to_pylist()
                start, held = i, 0
            held += size
        part = batch.slice(start)
        yield part, part.column(column).to_pylist()


def is_held_out(key: str = "doc_id"):
    """True for the fifth of the documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(rows: DataFrame, labels: DataFrame, key: str, label: str, sample: int, seed: int) -> DataFrame:
    """``(key, label, text)`` of at most ``sample`` different rows of ``(key, text)`` whose
    label is 0 or 1 and not held out, those with the smallest hashes. Of several labels of
    a key the greatest counts; many rows of one key are as likely as any others."""
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).where("label IN (0, 1)")
    known = known.where(~is_held_out("key")).groupBy("key").agg(F.max("label").alias("label"))
    keys = known.orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(sample)
    hashed = rows.withColumn("digest", F.xxhash64("text"))
    pairs = hashed.select("key", "digest").join(F.broadcast(keys), "key").distinct()
    chosen = pairs.orderBy(F.xxhash64(F.lit(seed), "key", "digest"), "key").limit(sample)
    return hashed.join(F.broadcast(chosen), ["key", "digest"]).dropDuplicates(["key", "digest"]).select("key", "label", "text")  # at most ``sample`` rows each


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    """One tokenizer for each Python worker; one thread, as a task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


_LOADED: dict = {}
