"""Scoring a stream. Every step from cleaning to tier is stateless, so the batch
functions apply unchanged and no watermark is needed."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kotomori.config import CLEAN, CleanSettings
from kotomori.operators.features import TfidfModel
from kotomori.plans.scoring import score_corpus


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, file_filter: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def write_stream(records: DataFrame, path: str, checkpoint: str, available_now: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """Append to Parquet; the checkpoint makes each record appear exactly once."""
    writer = records.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start(path)


def score_stream(rows: DataFrame, key: str, model: PipelineModel, features: TfidfModel, path: str, checkpoint: str, text: str = "text", clean: CleanSettings = CLEAN, **options) -> StreamingQuery:
    return write_stream(score_corpus(rows, key, model, features, text, clean), path, checkpoint, **options)
