"""Exact deduplication with a split for frequent digests.

Misra-Gries summaries of the partitions name the few digests that could be
frequent; their exact winners are broadcast and settle those rows where they
lie. All other groups are small and go through an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import SPACE, text_or_empty, unused, written

#: Counters of a summary; at most so many winners are broadcast, of about 100 bytes each.
COUNTERS = 4096


def _summary(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for digest, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                kept[digest] = kept.get(digest, 0) + n
            if len(kept) > counters:
                less = sorted(kept.values(), reverse=True)[counters]
                kept = {d: n - less for d, n in kept.items() if n > less}
        often = {d: n for d, n in kept.items() if n > 1}
        yield pa.RecordBatch.from_arrays([pa.array(often.keys(), pa.binary()), pa.array(often.values(), pa.int64())], names=["digest", "n"])

    return run


def frequent_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests of ``rows``: those that may have over 1 / counters of all rows.

    The merged lower bounds of the summaries fall short of a digest's true count
    by at most rows / (counters + 1), so all with twice that are among them.
    """
    least = max(4, rows.count() // (2 * counters))
    summed = rows.select("digest").mapInArrow(_summary(counters), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    return summed.filter(F.col("n") >= least).orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and the SHA-256 of each text without white space (null: empty), and a number for each row."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        F.length(text).cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.regexp_replace(text, SPACE, ""), 256)).alias("digest"),
    ).withColumn("row", F.monotonically_increasing_id())


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Which row of each group of equal texts stays.

    Texts are equal when they are identical without ``[\\x20\\x09-\\x0D]``; a null
    text is empty, and all empty texts are one group. The row with the most code
    points stays, then the smallest doc_id (null last), then the first of rows
    that are wholly repeated. Other columns of ``docs`` are not read. An empty
    table gives an empty result.

    Returns a row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, n_chars, frequent (settled by the broadcast winners).
    """
    rows = written(digests(docs), "digests")
    heavy = written(frequent_digests(rows, counters), "frequent")
    order = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    winners = rows.join(F.broadcast(heavy), "digest").groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("size"))
    settled = rows.join(F.broadcast(winners), "digest").withColumn("frequent", F.lit(True))
    group = W.partitionBy("digest")
    others = (
        rows.join(F.broadcast(heavy), "digest", "left_anti")
        .withColumns({"best": F.min(order).over(group), "size": F.count("*").over(group)})
        .withColumn("frequent", F.lit(False))
    )
    return settled.unionByName(others).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_chars",
        "frequent",
    )


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``docs`` with the row of each group that stays, and its columns as they were.

    Of rows that agree in doc_id and text but differ elsewhere, one stays.
    """
    found = written(exact_dedup(docs, counters).select("doc_id", "text_sha256", "n_chars", "kept"), "found")
    key = ["doc_id", "text_sha256", "n_chars"]
    stay = written(found.groupBy(*key).agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).filter("kept").drop("kept"), "stay")
    text = text_or_empty()
    digest, chars = unused(docs, "digest", "chars")
    keyed = docs.withColumns({digest: F.sha2(F.regexp_replace(text, SPACE, ""), 256), chars: F.length(text).cast("long")})

    def rows(of: DataFrame) -> DataFrame:
        same = keyed["doc_id"].eqNullSafe(of["doc_id"]) & (keyed[digest] == of["text_sha256"]) & (keyed[chars] == of["n_chars"])
        return keyed.join(of, same, "left_semi")

    repeated = stay.filter("rows > 1")
    if repeated.isEmpty():
        return rows(stay).select(*docs.columns)
    single, several = rows(stay.filter("rows = 1")), rows(repeated).dropDuplicates(["doc_id", digest, chars])
    return single.unionByName(several).select(*docs.columns)
