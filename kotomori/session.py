"""Session settings, and lineage cuts in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Session setting: partitions that scanned rows are dealt over; off unless set.
SPREAD = "spark.kotomori.scan.partitions"


def local_session(cores: int = 8, memory: str = "8g", app: str = "kotomori") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config(SPREAD, str(cores))
        .getOrCreate()
    )


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the number of partitions that ``SPREAD`` names, if it is set.

    For inputs of few files that Spark cannot split (a Parquet file of one row group, a
    multi-line CSV) and costly work behind the scan. It is a setting and no guess: sizes
    and cores play no part, and without it nothing is shuffled.
    """
    wanted = df.sparkSession.conf.get(SPREAD, None)
    return df if wanted is None else df.repartition(int(wanted))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder all executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="kotomori-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/kotomori/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` by a Parquet table in the shared folder.

    Unlike a cached frame the table outlives lost executors, and unlike an RDD
    checkpoint it keeps column pruning and known sizes.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
