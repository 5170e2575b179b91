"""Token counts without ids.

A byte-level tokenizer merges inside pre-tokens only, so a text has as many tokens as
its pre-tokens have together. Every distinct pre-token of the corpus is counted once;
documents keep pre-token frequencies and are joined to those counts.

A pre-token that makes up at least one ``shared``-th of all occurrences is frequent;
there are at most ``shared`` of those whatever the input, so that their counts are
given to every task. All other pre-tokens take part in an equi join, where no key is
hot: the frequent ones would have been.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, slices, table, texts, tokenizer_path
from kotomori.llm.pieces import byte_pieces, token_counts
from kotomori.session import pin


@dataclass(frozen=True)
class CountSettings:
    tokenizer: str
    #: Bound of the frequent pre-tokens that every task holds.
    shared: int = 1 << 19
    #: Longer pre-tokens are never among them, so their bytes are bounded, too.
    shared_chars: int = 48
    #: Distinct pre-tokens that a task sums before it hands them on.
    summed: int = 150_000


def piece_frequencies(rows: DataFrame, settings: CountSettings) -> DataFrame:
    """``(piece, n)``: how often each distinct pre-token occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = byte_pieces(settings.tokenizer), Counter()

        def flush():
            for k in range(0, len(pieces := list(seen)), 20_000):
                part = pieces[k : k + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([seen[p] for p in part], pa.int64())], ["piece", "n"])
            seen.clear()

        for _, part in slices(batches):
            for text in part:
                seen.update(split(text)[0])
                if len(seen) > settings.summed:
                    yield from flush()
        yield from flush()

    return rows.select("text").mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def with_token_counts(pieces: DataFrame, settings: CountSettings) -> DataFrame:
    """``(piece, n, tokens)``: every distinct pre-token counted once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = token_counts(settings.tokenizer, batch.column("piece").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int32())], ["piece", "n", "tokens"])

    return pieces.select("piece", "n").mapInArrow(encode, "piece string, n long, tokens int")


def count_tokens(docs: DataFrame, settings: CountSettings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens)``, one row for each row of ``docs``.

    A null or empty text has 0 bytes and tokens. Rows are told apart by their place,
    so null or repeated keys and repeated rows each keep a row of their own. No length
    limit; other columns are ignored.
    """
    spark, rows = docs.sparkSession, texts(docs, key, text)
    counted = pin(with_token_counts(piece_frequencies(rows, settings), settings), "pieces")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = (F.col("n") * settings.shared >= F.lit(total)) & (F.length("piece") <= settings.shared_chars)
    common = spark.sparkContext.broadcast({r.piece: r.tokens for r in counted.where(frequent).collect()})
    schema = f"row long, key {dict(rows.dtypes)['key']}, n_bytes long, piece string, n long"

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document a row with its frequent tokens, and a row for each other pre-token."""
        split, tokens, at = byte_pieces(settings.tokenizer), common.value, TaskContext.get().partitionId() << 40
        for batch, part in slices(batches):
            known = batch.column("key")
            names, owners, sizes, pieces, counts = [], [], [], [], []
            for i, text in enumerate(part):
                found, sum_ = split(text)
                name, at = at, at + 1
                for piece, n in Counter(found).items():
                    t = tokens.get(piece)
                    if t is not None:
                        sum_ += t * n
                    else:
                        names.append(name)
                        owners.append(None)
                        sizes.append(None)
                        pieces.append(piece)
                        counts.append(n)
                names.append(name)
                owners.append(i)
                sizes.append(len(text.encode()))
                pieces.append(None)
                counts.append(sum_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), known.take(pa.array(owners, pa.int32())), pa.array(sizes, pa.int64()), pa.array(pieces, pa.string()), pa.array(counts, pa.int64())],
                ["row", "key", "n_bytes", "piece", "n"],
            )

    # A document's own row meets no pre-token: its key is unlike any, and unlike the others'.
    own = F.concat(F.lit("\x00\x00"), F.col("row").cast("string"))
    left = rows.mapInArrow(frequencies, schema).withColumn("own", F.col("piece").isNull()).withColumn("piece", F.coalesce("piece", own))
    right = counted.where(~frequent).select("piece", "tokens")
    share = F.when(F.col("own"), F.col("n")).otherwise(F.col("n") * F.col("tokens"))
    return (
        left.join(right, "piece", "left")
        .groupBy("row")
        .agg(F.max("key").alias(key), F.max("n_bytes").alias("n_bytes"), F.sum(share).alias("n_tokens"))
        .drop("row")
    )


@register("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    settings = CountSettings(tokenizer_path("byte_bpe_50k.json"))
    counts = count_tokens(table(spark, sf, "documents"), settings)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)
