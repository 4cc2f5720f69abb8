"""The rows of manifests as bucketed tables, which Spark joins where they lie.

A manifest's format is one CSV file, which every run would have to parse and move
whole. Beside it a session with a lasting catalog can keep the same rows bucketed and
sorted by submission: only the small side of a join is then dealt out. Which tables
belong to a version of the manifests stands in its record (see versions).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "submission_id"
#: Buckets of a table, and so tasks of its joins.
BUCKETS = 256
#: Bits of a filter of ids: 16 MB in rows of 4 KB, at most, are broadcast, however many ids there are.
BITS = 1 << 27
_BITMAP = 4096 * 8


def save(df: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """``df`` as a table of this name, a file a bucket; in the warehouse, or at ``path``."""
    writer = df.repartition(buckets, KEY).write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).mode("errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def save_all(spark: SparkSession, prefix: str, manifests: dict[str, DataFrame], buckets: int = BUCKETS) -> dict[str, str]:
    """Tables of ``manifests`` (kind: rows) under new names: kind and name."""
    mark = uuid.uuid4().hex[:12]
    names = {kind: f"{prefix}_{kind}_{mark}" for kind in manifests}
    for kind, df in manifests.items():
        save(df, names[kind], buckets)
    return names


def load(spark: SparkSession, record: dict | None) -> dict[str, DataFrame]:
    """The tables of a version, if this session's catalog has all of them; else none."""
    names = (record or {}).get("state") or {}
    if not names or not all(spark.catalog.tableExists(n) for n in names.values()):
        return {}
    return {kind: spark.table(name) for kind, name in names.items()}


def drop(spark: SparkSession, names: dict[str, str] | None) -> None:
    for name in (names or {}).values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _bit(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def id_filter(ids: DataFrame, key: str = KEY, bits: int = BITS) -> DataFrame:
    """Which bits the hashes of ``ids`` set: part, bitmap. At most bits / 32768 rows of 4 KB."""
    bit = _bit(key, bits)
    return ids.groupBy(F.floor(bit / _BITMAP).alias("part")).agg(F.bitmap_construct_agg(bit % _BITMAP).alias("bitmap"))


def marked(rows: DataFrame, maps: DataFrame, key: str = KEY, bits: int = BITS) -> DataFrame:
    """``rows`` with ``_maybe``: false only for keys that the filter surely does not hold. The filter is broadcast; rows stay where they are."""
    at = _bit(key, bits)
    place = (at % _BITMAP).cast("int")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    own = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1
    joined = rows.withColumn("_part", F.floor(at / _BITMAP)).join(F.broadcast(maps.withColumnRenamed("part", "_part")), "_part", "left")
    return joined.withColumn("_maybe", F.coalesce(own, F.lit(False))).drop("_part", "bitmap")


def carried(state: DataFrame, work: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows of a bucketed ``state`` whose submission is not worked on, as ``relational.carried``.

    Most rows are let through by a filter of the ids of ``work``, without a join; the
    others meet ``work``, which is dealt out as the buckets are.
    """
    ids = work.select(KEY).distinct()
    told = marked(state, id_filter(ids, bits=bits), bits=bits)
    sure = told.filter("NOT _maybe").drop("_maybe")
    return sure.unionByName(told.filter("_maybe").drop("_maybe").join(ids, KEY, "left_anti"))
