"""Hand-over tables of operators that need several jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`; in local mode one of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="spendlens-scratch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def handed_over(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, and outlives the executors that made it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
