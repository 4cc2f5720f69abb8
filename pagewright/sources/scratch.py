"""Intermediate tables in a folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session in local mode may leave it unset, and then gets a temporary folder for its lifetime."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = getattr(spark, "_pagewright_scratch", None)
    if folder is None:
        folder = spark._pagewright_scratch = tempfile.mkdtemp(prefix="spark-")
    return folder


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a table there, so that what tasks did is not done again."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
