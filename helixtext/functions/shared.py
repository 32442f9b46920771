"""Folders that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir; a folder of one machine would be lost to the others."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder: lineage is cut, and what reads them twice sees the same."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_path(spark))
    return df.checkpoint()
