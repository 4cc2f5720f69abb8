"""Submissions of a source tree: one for each descriptor, wherever it lies."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.exprs import parent_id, parent_path
from pagewright.schema import DESCRIPTOR
from pagewright.sources.scratch import kept
from pagewright.sources.storage import Storage

FOUND = "path string"


def listed(spark: SparkSession, storage: Storage, prefix: str = "", name: str = DESCRIPTOR) -> DataFrame:
    """Paths of all files of a name, hidden folders too.

    Level by level: tasks list the folders of one level each for itself, and what
    they find is dealt out again, so neither the driver nor a task holds a tree,
    and a root with one folder is no bottleneck.
    """

    def children(batches):
        for rows in batches:
            for folder in rows.column("path").to_pylist():
                inner = storage.list_prefixes(folder)
                here = [p for p in storage.list_files(folder) if p.rsplit("/", 1)[-1] == name]
                kinds = pa.array([True] * len(inner) + [False] * len(here), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(inner + here, pa.string()), kinds], names=["path", "folder"])

    parts = 8 * spark.sparkContext.defaultParallelism
    level, found = spark.createDataFrame([(prefix,)], FOUND), spark.createDataFrame([], FOUND)
    while True:
        seen = kept(level.mapInArrow(children, "path string, folder boolean"))
        found = found.unionByName(seen.filter("NOT folder").select("path"))
        level = seen.filter("folder").select("path").repartition(parts)
        if seen.filter("folder").isEmpty():
            return found


def discover(spark: SparkSession, storage: Storage, prefix: str = "") -> DataFrame:
    """submission_id (the folder of a descriptor) and source_path of each; a descriptor at the root has no id and is left out. Equal ids stay."""
    path = F.col("path")
    found = listed(spark, storage, prefix).select(parent_id(path).alias("submission_id"), parent_path(path).alias("source_path"))
    return found.filter("submission_id IS NOT NULL")


def repeated_ids(found: DataFrame) -> DataFrame:
    """Ids that more than one folder has."""
    return found.groupBy("submission_id").agg(F.count("*").alias("n"), F.min("source_path").alias("first")).filter("n > 1")
