"""Folders for intermediate files that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder under spark.checkpoint.dir; a temporary one only where that is unset on a local master (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.conf.get("spark.master", "local").partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-shared-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written there and read again, for results that are read several times."""
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
