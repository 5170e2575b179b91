"""TF-IDF features: corpus statistics, vocabulary, long form and vectors.

Two blocks, words and in-word characters, are fitted and normalised apart and
then laid side by side. The long form ``(id, block, term_id, weight)`` is for
analysis; :class:`TfidfModel` turns rows into sparse vectors without a shuffle
and is what models and streams use.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, NGram, SQLTransformer, Tokenizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kotomori.config import FEATURES, FeatureSettings
from kotomori.functions.grams import (
    batch_counts,
    batch_sums,
    char_ngrams,
    inline_counts,
    spaced,
    strip_accents,
    with_term_counts,
    word_ngrams,
    word_tokens,
)
from kotomori.session import pin

BLOCKS = ("word", "char")


def with_terms(df: DataFrame, text: str, block: str, out: str = "terms", settings: FeatureSettings = FEATURES) -> DataFrame:
    """Add the array of all terms of a block, repeats included."""
    source = F.coalesce(F.col(text), F.lit(""))
    if block == "word":
        tokens = df.withColumn("_tokens", word_tokens(strip_accents(source)))
        return tokens.withColumn(out, word_ngrams(F.col("_tokens"), *settings.word_ngrams)).drop("_tokens")
    return df.withColumn(out, char_ngrams(source, *settings.char_ngrams))


def document_terms(df: DataFrame, key: str, text: str, block: str, settings: FeatureSettings = FEATURES) -> DataFrame:
    """``(key, term, tf)``, one row per distinct term of a document; no shuffle."""
    terms = with_terms(df.select(key, text), text, block, settings=settings).drop(text)
    return inline_counts(with_term_counts(terms, "terms"), key)


def corpus_terms(df: DataFrame, text: str, block: str, settings: FeatureSettings = FEATURES) -> DataFrame:
    """``(term, df, corpus_tf)`` of all terms.

    The terms of a batch of documents are counted together, and frequent terms are combined
    in their task before they are shuffled.
    """
    low, high = getattr(settings, f"{block}_ngrams")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sums in batch_sums(batch.column(0).to_pylist(), block, low, high):
                yield pa.record_batch([pa.array(x) for x in sums], ["term", "df", "corpus_tf"])

    texts = df.select(spaced(F.coalesce(F.col(text), F.lit("")), block).alias("_text"))
    counted = texts.mapInArrow(count, "term string, df long, corpus_tf long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("corpus_tf").alias("corpus_tf"))


def doc_freq(df: DataFrame, text: str, block: str, settings: FeatureSettings = FEATURES) -> DataFrame:
    """:func:`corpus_terms` within the document-frequency limits."""
    n_docs = df.select(F.count(F.lit(1))).scalar()
    within = (F.col("df") >= settings.min_df) & (F.col("df") <= n_docs * F.lit(settings.max_df))
    return corpus_terms(df, text, block, settings).where(within)


def vocab_topk(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms of highest corpus frequency, ties by term.

    A histogram over powers of two finds the band the k-th term lies in; only
    the terms from that band upwards enter the sort behind the limit. Both read a table, so
    the statistics are made once.
    """
    stats = pin(stats, "term-stats")
    bands = stats.groupBy(F.length(F.bin("corpus_tf")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
    # at most 63 bands, so this window is over 63 rows
    above = F.sum("n").over(Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1))
    first = (
        bands.select("band", F.coalesce(above, F.lit(0)).alias("above"))
        .where(F.col("above") < k)
        .agg(F.min("band"))
        .scalar()
    )
    return (
        stats.where(F.length(F.bin("corpus_tf")) >= first)
        .orderBy(F.desc("corpus_tf"), "term")
        .limit(k)
    )


def smooth_idf(n_docs, df):
    return F.log((n_docs + F.lit(1.0)) / (df + F.lit(1.0))) + F.lit(1.0)


def sublinear_tf(tf):
    return F.log(tf) + F.lit(1.0)


def vocabulary(df: DataFrame, text: str, block: str, settings: FeatureSettings = FEATURES) -> DataFrame:
    """``(block, term, term_id, df, corpus_tf, idf)``; ids count terms in code point order."""
    cap = settings.max_word_terms if block == "word" else settings.max_char_terms
    kept = vocab_topk(doc_freq(df, text, block, settings), cap)
    n_docs = df.select(F.count(F.lit(1))).scalar()
    # the window is over the capped vocabulary, never over the corpus
    term_id = F.row_number().over(Window.partitionBy("block").orderBy("term")) - 1
    return kept.withColumn("block", F.lit(block)).select(
        "block",
        "term",
        term_id.alias("term_id"),
        "df",
        "corpus_tf",
        smooth_idf(n_docs, F.col("df")).alias("idf"),
    )


def feature_union(word: DataFrame, char: DataFrame) -> DataFrame:
    """One vocabulary: character ids follow the word ids."""
    n_words = word.select(F.count(F.lit(1))).scalar()
    shifted = char.withColumn("term_id", (F.col("term_id") + n_words).cast("int"))
    return word.unionByName(shifted)


def fit_vocabulary(df: DataFrame, text: str, settings: FeatureSettings = FEATURES) -> DataFrame:
    return feature_union(*[vocabulary(df, text, b, settings) for b in BLOCKS])


def tfidf_long(df: DataFrame, key: str, text: str, vocab: DataFrame, block: str, settings: FeatureSettings = FEATURES) -> DataFrame:
    """``(key, block, term_id, term, tf, weight)``, unit length per row and block; rows that share
    a key share their length.

    The vocabulary has at most ``max_word_terms``/``max_char_terms`` rows, as many as go to
    every task. Terms are counted by batch, and a document stays one row until its length is known.
    """
    cap = settings.max_word_terms if block == "word" else settings.max_char_terms
    local = vocab.where(F.col("block") == block).select("term", "term_id", "idf").limit(cap + 1).toPandas()
    if len(local) > cap:
        raise ValueError(f"vocabulary exceeds {cap} terms")
    known = (local["term"].tolist(), local["term_id"].to_numpy(np.int32), local["idf"].to_numpy(np.float64))
    shared = df.sparkSession.sparkContext.broadcast(known)
    low, high = getattr(settings, f"{block}_ngrams")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, ids, idf = shared.value
        terms = pa.array(terms, pa.string())
        for batch in batches:
            for start, end, row, term, tf in batch_counts(batch.column(1).to_pylist(), block, low, high):
                at = pc.index_in(term.dictionary, value_set=terms).take(term.indices)
                found = at.is_valid().to_numpy(zero_copy_only=False)
                at, row, tf = at.drop_null().to_numpy(), row[found], tf[found]
                order = np.lexsort((at, row))
                at, row, tf = at[order], row[order], tf[order]
                raw = (1.0 + np.log(tf)) * idf[at]
                cells = pa.StructArray.from_arrays([pa.array(ids[at]), terms.take(pa.array(at)), pa.array(tf), pa.array(raw)], ["term_id", "term", "tf", "raw"])
                n = np.bincount(row, minlength=end - start)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), cells)
                squares = pa.array(np.bincount(row, weights=raw * raw, minlength=end - start).astype(np.float64))  # whole numbers without rows
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), lists, squares], ["key", "cells", "squares"])

    texts = df.select(F.col(key).alias("key"), spaced(F.coalesce(F.col(text), F.lit("")), block).alias("_text"))
    cell = "array<struct<term_id: int, term: string, tf: long, raw: double>>"
    counted = texts.mapInArrow(count, f"key {texts.schema['key'].dataType.simpleString()}, cells {cell}, squares double")
    norm = F.sqrt(F.sum("squares").over(Window.partitionBy("key")))
    inlined = counted.withColumn("norm", norm).select("key", "norm", F.inline("cells"))
    return inlined.select(
        F.col("key").alias(key), F.lit(block).alias("block"), "term_id", "term", "tf", (F.col("raw") / F.col("norm")).alias("weight")
    )


class TfidfModel:
    """A frozen two-block vocabulary.

    It lives on the driver like any Spark ML model; its size is bounded by the
    vocabulary limits of the settings it was fitted with.
    """

    def __init__(self, vocab: DataFrame, settings: FeatureSettings = FEATURES):
        self.spark: SparkSession = vocab.sparkSession
        self.settings = settings
        self.table = vocab
        limit = settings.max_word_terms + settings.max_char_terms
        local = vocab.select("block", "term", "term_id", "idf").limit(limit + 1).toPandas()
        if len(local) > limit:
            raise ValueError(f"vocabulary exceeds {limit} terms")
        self.size = len(local)
        self._blocks = []
        for block in BLOCKS:
            table = local[local.block == block].sort_values("term_id")
            if not table.empty:
                self._blocks.append((block, table.term.tolist(), table.term_id.to_numpy(np.int32), table.idf.to_numpy()))

    @classmethod
    def fit(cls, df: DataFrame, text: str = "processed_text", settings: FeatureSettings = FEATURES) -> TfidfModel:
        return cls(pin(fit_vocabulary(df, text, settings), "vocabulary"), settings)

    def save(self, path: str) -> None:
        """Terms and settings, as two tables below ``path``."""
        self.table.coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")
        row = self.spark.range(1).select(F.lit(json.dumps(asdict(self.settings))).alias("value"))
        row.coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str, settings: FeatureSettings | None = None) -> TfidfModel:
        """The saved model; settings that are given have to be those it was fitted with."""
        saved = json.loads(spark.read.text(f"{path}/settings").first().value)
        found = FeatureSettings(**{k: tuple(v) if isinstance(v, list) else v for k, v in saved.items()})
        if settings is not None and settings != found:
            raise ValueError(f"fitted with {found}, not {settings}")
        return cls(spark.read.parquet(f"{path}/terms"), found)

    def transform(self, df: DataFrame, text: str = "processed_text", out: str = "features") -> DataFrame:
        """Add the sparse vector of ``text``; stateless, so it also runs on streams."""
        source = F.coalesce(F.col(text), F.lit(""))
        return df.withColumn(out, self._weigher()(*[spaced(source, block) for block, *_ in self._blocks] or [source]))

    def _weigher(self):
        size, settings = self.size, self.settings
        shared = self.spark.sparkContext.broadcast(self._blocks)

        # a sparse vector is transported as the struct behind its type
        @F.pandas_udf(VectorUDT())
        def weigh(*texts: pd.Series) -> pd.DataFrame:
            cells = [([np.empty(0, np.int32)], [np.empty(0)]) for _ in texts[0]]
            for column, (block, terms, ids, idf) in zip(texts, shared.value):
                known = pa.array(terms, pa.string())
                for start, _, row, term, tf in batch_counts(column.tolist(), block, *getattr(settings, f"{block}_ngrams")):
                    at = pc.index_in(term.dictionary, value_set=known).take(term.indices)
                    found = at.is_valid().to_numpy(zero_copy_only=False)
                    at, row, tf = at.drop_null().to_numpy(), row[found], tf[found]
                    order = np.lexsort((at, row))
                    at, row, tf = at[order], row[order], tf[order]
                    w = (1.0 + np.log(tf)) * idf[at]
                    w, each = w / np.sqrt(np.bincount(row, weights=w * w))[row], ids[at]
                    starts = np.flatnonzero(np.diff(row, prepend=-1))
                    for i, j in zip(starts, np.append(starts[1:], len(row))):
                        cells[start + row[i]][0].append(each[i:j])
                        cells[start + row[i]][1].append(w[i:j])
            sides = {name: pd.Series([np.concatenate(c[k]) for c in cells], dtype=object) for k, name in enumerate(("indices", "values"))}
            return pd.DataFrame({"type": np.zeros(len(cells), np.int8), "size": size, **sides})

        return weigh


def matrix_shape(long: DataFrame, key: str) -> DataFrame:
    """Rows, columns in use and non-zero cells of a long-form matrix, from one pass over its
    cells: each task hands on what is distinct in it."""
    return long.agg(
        F.count_distinct(F.struct(key)).alias("n_rows"),
        F.count_distinct(F.struct("block", "term_id")).alias("n_cols"),
        F.sum(F.lit(1).cast("long")).alias("nnz"),
    )


def hashed_tfidf(
    text: str = "processed_text",
    buckets: int = 100_000,
    min_doc_freq: int = 2,
    hash_bigrams: bool = False,
) -> Pipeline:
    """Hashed TF-IDF; bigrams are built but hashed only on request."""
    stages = [
        Tokenizer(inputCol=text, outputCol="tokens"),
        NGram(n=2, inputCol="tokens", outputCol="bigrams"),
    ]
    source = "tokens"
    if hash_bigrams:
        stages.append(SQLTransformer(statement="SELECT *, concat(tokens, bigrams) AS grams FROM __THIS__"))
        source = "grams"
    stages += [
        HashingTF(inputCol=source, outputCol="raw_features", numFeatures=buckets),
        IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq),
    ]
    return Pipeline(stages=stages)


def fit_hashed_tfidf(df: DataFrame, text: str = "processed_text", path: str | None = None, **options) -> PipelineModel:
    model = hashed_tfidf(text, **options).fit(df)
    if path:
        model.write().overwrite().save(path)
    return model
