"""Phrases of a large lexicon in texts, by an index of rare grams.

Every phrase is filed under one of its grams of ``size`` characters, the one that fewest
texts hold. A text that contains the phrase holds that gram, wherever words begin, so an
equi join of the index with the distinct grams of a text finds all candidates and few
others; the phrases themselves are then looked for in the row. The work follows the texts
and the phrases found and not texts times phrases, and neither side has to fit in a task.

Grams are hashes, cut and hashed a text at a time. A bit for each hash of the index, in a
field of fixed length that goes to every task, drops most grams that are in no phrase where
they are cut; the join decides on the others. A hash that two grams share makes a candidate
that is not found in the row.

Candidates are keyed by a hash of the text, so rows need no key of their own and rows with
equal texts share theirs; what two texts of one hash find of each other goes when the row
looks for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotomori.config import LABELS
from kotomori.session import pin

#: Characters in a gram; a shorter phrase is filed under itself. Grams of a few characters are
#: in most long texts, so that most phrases would be candidates of most texts.
SIZE = 8
#: Bits of the field that tasks get of an index, as a power of two: 16 MB whatever the index.
FIELD = 27


def gram_hashes(text: str, n: int) -> np.ndarray:
    """The hash of each run of ``n`` characters, in order."""
    units = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    m = max(len(units) - n + 1, 0)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = (h ^ units[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _place(grams: np.ndarray) -> np.ndarray:
    return grams.view(np.uint64) >> np.uint64(64 - FIELD)


def hash_field(filed: DataFrame):
    """A test for grams that are in no row of ``filed``, as a broadcast bit field."""
    place = F.shiftrightunsigned("gram", 64 - FIELD)
    words = filed.groupBy(F.shiftrightunsigned(place, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
    found, field = words.toPandas(), np.zeros(1 << (FIELD - 6), np.int64)  # 2^(FIELD - 6) rows at most
    field[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return filed.sparkSession.sparkContext.broadcast(field)


def _cut(field, sizes: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column(0).to_numpy()
            held, n_held, at = [], 0, []
            for digest, text in zip(digests, batch.column(1).to_pylist()):
                for n in sizes:
                    each = gram_hashes(text, n)
                    place = _place(each)
                    bits = field.value[(place >> np.uint64(6)).view(np.int64)] >> (place & np.uint64(63)).view(np.int64)
                    each = np.unique(each[(bits & 1).astype(bool)])
                    held.append(each)
                    at.append(np.full(len(each), digest))
                    n_held += len(each)
                if n_held > 1 << 20:
                    yield pa.record_batch({"digest": np.concatenate(at), "gram": np.concatenate(held)})
                    held, n_held, at = [], 0, []
            if held:
                yield pa.record_batch({"digest": np.concatenate(at), "gram": np.concatenate(held)})

    return cut


def text_grams(df: DataFrame, text: str, filed: DataFrame) -> DataFrame:
    """``(digest, gram)``: the distinct grams of each row's text that ``filed``, a table with
    ``gram`` and ``gram_size``, may hold; all that it does hold are among them."""
    sizes = sorted(r.gram_size for r in filed.select("gram_size").distinct().collect())  # at most the index's size in numbers
    texts = df.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("_text"))
    return texts.mapInArrow(_cut(hash_field(filed), sizes), "digest long, gram long")


def phrase_grams(phrases: DataFrame, size: int) -> DataFrame:
    """``(phrase, gram_size, gram)``: the distinct grams of each phrase."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = batch.column(0)
            sizes = [min(len(p), size) for p in phrases.to_pylist()]
            each = [np.unique(gram_hashes(p, n)) for p, n in zip(phrases.to_pylist(), sizes)]
            at = np.repeat(np.arange(len(each)), [len(x) for x in each])
            if len(at):
                yield pa.record_batch({"phrase": phrases.take(pa.array(at)), "gram_size": np.array(sizes, np.int32)[at], "gram": np.concatenate(each)})

    return phrases.select("phrase").mapInArrow(cut, "phrase string, gram_size int, gram long")


def phrase_index(phrases: DataFrame, texts: DataFrame | None = None, text: str = "text", size: int = SIZE) -> DataFrame:
    """``(gram, phrase, gram_size)``: each distinct phrase under its rarest gram, as a table.

    Rare is what few rows of ``texts`` hold, or without them what few phrases hold; ties go
    to the first gram in order. Null and empty phrases are left out.
    """
    known = phrases.select("phrase").where("phrase <> ''").distinct()
    spread = pin(phrase_grams(known, size), "phrase-grams")
    if texts is None:
        counts = spread.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = text_grams(texts, text, spread).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rated = spread.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = rated.groupBy("phrase", "gram_size").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return pin(rarest.select("gram", "phrase", "gram_size"), "phrase-index")


def candidates(df: DataFrame, text: str, index: DataFrame) -> DataFrame:
    """``(digest, phrase)`` of texts that hold the gram of a phrase."""
    return text_grams(df, text, index).join(index.select("gram", "phrase"), "gram").select("digest", "phrase")


def with_phrases(df: DataFrame, text: str, index: DataFrame, out: str = "phrases_found") -> DataFrame:
    """Add ``out``, the phrases of the index that the text contains, in code point order; an
    empty array for none. All rows and columns stay."""
    per_text = candidates(df, text, index).groupBy("digest").agg(F.collect_set("phrase").alias("_candidates"))
    hashed = df.withColumn("_digest", F.xxhash64(F.col(text)))
    joined = hashed.join(per_text, F.col("_digest") == F.col("digest"), "left")
    held = F.filter("_candidates", lambda p: F.contains(F.col(text), p))
    none = F.array().cast("array<string>")
    return joined.withColumn(out, F.coalesce(F.sort_array(held), none)).drop("_digest", "digest", "_candidates")


def with_indexed_taxonomy(scored: DataFrame, taxonomy: DataFrame, text: str, index: DataFrame) -> DataFrame:
    """As :func:`~kotomori.operators.triage.with_taxonomy`, for a taxonomy of any size: the
    longest phrase of the row's class that the text contains decides, then the taxonomy's
    order. ``index`` holds the taxonomy's phrases."""
    name = F.col("name") if "name" in taxonomy.columns else F.lit(None).cast("string")
    entry = F.struct(F.char_length("phrase").alias("len"), (-F.col("position")).alias("rank"), "phrase", "subcategory", "escalate", name.alias("name"))
    terms = taxonomy.where("phrase IS NOT NULL").select("phrase", F.col("class").alias("_class"), entry.alias("_entry"))
    found = candidates(scored, text, index).distinct().join(terms, "phrase")
    per_text = found.groupBy("digest").agg(F.collect_list(F.struct("_class", "_entry")).alias("_terms"))
    joined = scored.withColumn("_digest", F.xxhash64(F.col(text))).join(per_text, F.col("_digest") == F.col("digest"), "left")

    def fits(term: Column) -> Column:
        of_class = (term["_class"].isNull() & F.col("predicted_class").isin(*LABELS)) | (term["_class"] == F.col("predicted_class"))
        return of_class & F.contains(F.col(text), term["_entry"]["phrase"])

    best = F.array_max(F.transform(F.filter("_terms", fits), lambda t: t["_entry"]))
    return (
        joined.withColumn("_best", best)
        .withColumns(
            {
                "category": F.col("predicted_class"),
                "subcategory": F.col("_best.subcategory"),
                "subcategory_name": F.col("_best.name"),
                "subcategory_escalate": F.col("_best.escalate"),
            }
        )
        .drop("_best", "_terms", "_digest", "digest")
    )
