"""Corpus readers. Any Hadoop URI works; schemas are always explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail before any job runs if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; found {df.columns}")
    return df


def scan_corpus(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CORPUS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, read by its names in any order.

    ``schema`` types the columns it names; others are strings, and what the header lacks
    is missing from the result. All files need the header of the first; Spark refuses
    others. Rows that do not parse carry their text in ``_corrupt_record``; see
    :func:`split_corrupt`.

    Quoted line breaks keep a CSV file from being split, so large corpora belong
    in many files, or in Parquet; ``multi_line=False`` splits again.
    """
    options = {
        "header": True,
        "multiLine": multi_line,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "columnNameOfCorruptRecord": CORRUPT,
        "enforceSchema": False,
    }
    header = spark.read.options(**options).csv(path).columns  # reads the first line
    known = {f.name: f for f in schema.fields}
    fields = [known.get(name, T.StructField(name, T.StringType())) for name in header]
    checked = T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])
    return spark.read.options(**options).schema(checked).csv(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows, rows that did not parse)``.

    The test names every column: Spark parses only the columns a query needs, and
    whether a row is good must not depend on what is selected from it later.
    """
    columns = [c for c in df.columns if c != CORRUPT]
    bad = F.col(CORRUPT).isNotNull() & (F.xxhash64(*columns) >= F.lit(-(2**63)))
    return df.where(~bad).drop(CORRUPT), df.where(bad)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(word, cost)`` of a segmentation dictionary: CSV files with a header, by its names. A
    cost that is no whole number is null, which stands for the default cost."""
    rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    if "word" not in rows.columns:
        raise ValueError(f"{path} has no column 'word'")
    cost = F.expr("try_cast(cost AS bigint)") if "cost" in rows.columns else F.lit(None).cast("bigint")
    return rows.select("word", cost.alias("cost"))
