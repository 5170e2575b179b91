"""From raw documents to packed sequences, in five stages.

Each stage works on all that the one before it kept. What a stage decides for a row
(drop it, change its text, repeat it) is applied to the row itself, so stages number the
rows they were given in a written table and join their decisions by that number: ids may
be missing or repeated. Every stage but the last returns the columns of documents and no
others; an empty table gives none of its rows. A null text counts as empty and stays null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import table, tokenizer_path
from kotomori.llm.mixing import MixSettings, longer_first, mix
from kotomori.llm.packing import PackSettings, pack
from kotomori.llm.quality import QualitySettings, with_quality
from kotomori.llm.secrets import SecretSettings, redact
from kotomori.llm.simhash import SimHashSettings, near_duplicates
from kotomori.session import pin

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Documents with a smaller probability of good quality go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    scored = with_quality(spark, docs.select(*COLUMNS), table(spark, sf_dir, "labels"), QualitySettings())
    return scored.where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def numbered(docs: DataFrame) -> DataFrame:
    return pin(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "numbered")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first row of each group of near duplicates, by the shingles and the bit
    distance of the SimHash operator."""
    rows = numbered(docs)
    groups = near_duplicates(rows, SimHashSettings(), key="row")
    return rows.join(groups.where(F.col("row") == F.col("component_id")).select("row"), "row", "left_semi").select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets, and what is linked to them, in the texts; all rows stay."""
    clean = redact(docs.select(*COLUMNS), SecretSettings())
    changed = F.length("text").cast("long")
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed)).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources reach their target weights."""
    rows = numbered(docs)
    copies = mix(rows, MixSettings(), key="row", weight=longer_first(), drawn_by=("doc_id", "text")).select("row", "copies")
    taken = rows.join(copies.where("copies > 0"), "row")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return pack(docs, PackSettings(tokenizer_path("word_bpe_49k.json")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", deduplicated),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
