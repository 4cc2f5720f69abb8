"""What several operators need: tables in the shared folder, and the white space of the contracts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sources.state import BITS, id_filter, marked

#: White space of every contract here: the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session in local mode, where all run on one machine, may leave the
    setting out; it then gets a temporary folder for its lifetime.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = getattr(spark, "_pagewright_folder", None)
    if folder is None:
        folder = spark._pagewright_folder = tempfile.mkdtemp(prefix="spark-")
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    This cuts lineage: a lost executor costs a reread, not the work before it.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """A dictionary that lives as long as this Python worker works for ``owner``: what it kept for another goes, as workers are used again."""
    if owner not in _KEPT:
        _KEPT.clear()
        _KEPT[owner] = {}
    return _KEPT[owner]


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be none of the columns of ``df``, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def having_ids(rows: DataFrame, ids: DataFrame, key: str = "doc_id", bits: int = BITS) -> DataFrame:
    """``rows`` whose ``key`` is in ``ids``, none for a null one; ``rows`` has no columns _part, _maybe or bitmap.

    A filter of ids, which is broadcast in at most ``bits`` / 8 bytes, drops most
    others where they lie; only what it lets through is dealt out for the join.
    """
    own = ids.select(F.col(key).cast(rows.schema[key].dataType).alias(key)).distinct()
    return marked(rows, id_filter(own, key, bits), key, bits).filter("_maybe").drop("_maybe").join(own, key, "left_semi")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
