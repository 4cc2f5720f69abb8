"""Shards of near equal bytes by fixed virtual slots.

Records hash into a fixed number of slots. A map from slot to shard, versioned
and small, says where a slot lies; growing or rebalancing edits the map and
moves only the slots that it must. Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, unused, written

#: Virtual slots; fixed for the life of a corpus, so that a record never changes its slot.
SLOTS = 8192


def virtual_slot(slots: int = SLOTS) -> Column:
    """A hash of doc_id; rows without one are spread by their text."""
    text = text_or_empty()
    by_text = F.xxhash64(F.crc32(F.encode(text, "UTF-8")), F.octet_length(text))
    return F.pmod(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(by_text), F.lit(slots)).cast("int")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of each row."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        virtual_slot(slots).alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot that has any; at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def _least_loaded(shards: int, loads: str, entries: str) -> str:
    """SQL: the shard for each of ``entries`` in turn, always the one with the least bytes so far, as an array."""
    least = "array_position(s.loads, array_min(s.loads))"
    return f"""aggregate({entries},
        named_struct('loads', {loads}, 'taken', cast(array() AS array<bigint>)),
        (s, e) -> named_struct(
            'loads', transform(s.loads, (x, i) -> IF(i + 1 = {least}, x + greatest(e.bytes, 1), x)),
            'taken', concat(s.taken, array({least} - 1))),
        s -> s.taken)"""


def slot_map(bytes_by_slot: DataFrame, shards: int, before: DataFrame | None = None, version: int = 0, slots: int = SLOTS) -> DataFrame:
    """A map of version ``version`` of all slots, empty ones too: virtual_slot, shard, version, bytes, rows.

    Without ``before``, slots go from the largest down, each to the shard with the
    least bytes. With ``before`` (an earlier map) a shard keeps its largest slots
    up to an even share of all bytes; only what is over that, and slots whose
    shard is gone, goes to the least loaded shards. An empty slot counts as one byte
    and stays where it is. The map has ``slots`` rows, so the one task that orders
    them is bounded.
    """
    every = bytes_by_slot.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    bytes_by_slot = every.join(bytes_by_slot, "virtual_slot", "left").fillna(0, ["bytes", "rows"])
    if before is None:
        placed = bytes_by_slot.withColumn("stays", F.lit(None).cast("long"))
    else:
        old = before.select("virtual_slot", F.col("shard").cast("long").alias("old"))
        share = bytes_by_slot.agg((F.sum("bytes") / shards).alias("share"))
        running = F.sum("bytes").over(W.partitionBy("old").orderBy(F.desc("bytes"), "virtual_slot"))
        placed = (
            bytes_by_slot.join(F.broadcast(old), "virtual_slot", "left")
            .join(F.broadcast(share))
            .withColumn("stays", F.when((F.col("old") < shards) & ((running <= F.col("share")) | (F.col("bytes") == 0)), F.col("old")))
            .select(*bytes_by_slot.columns, "stays")
        )
    entry = "struct(-bytes AS less, virtual_slot, bytes, rows)"
    zeros = f"transform(sequence(0, {shards - 1}), i -> 0L)"
    grouped = placed.groupBy().agg(
        F.expr(f"sort_array(collect_list({entry}) FILTER (WHERE stays IS NULL))").alias("moving"),
        F.expr("collect_list(struct(virtual_slot, stays, bytes, rows)) FILTER (WHERE stays IS NOT NULL)").alias("staying"),
    )
    loads = f"transform(sequence(0, {shards - 1}), k -> aggregate(filter(staying, e -> e.stays = k), 0L, (a, e) -> a + e.bytes))" if before is not None else zeros
    dealt = grouped.withColumn("loads", F.expr(loads)).withColumn("taken", F.expr(_least_loaded(shards, "loads", "moving")))
    every = F.expr(
        "concat(transform(moving, (e, i) -> struct(e.virtual_slot AS virtual_slot, taken[i] AS shard, e.bytes AS bytes, e.rows AS rows)),"
        " transform(staying, e -> struct(e.virtual_slot AS virtual_slot, e.stays AS shard, e.bytes AS bytes, e.rows AS rows)))"
    )
    return dealt.select(F.inline(every)).select("virtual_slot", F.col("shard").cast("int").alias("shard"), F.lit(version).alias("version"), "bytes", "rows")


def place(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The shard of each row, and its place there: gapless from 0, by virtual slot, doc_id and checksum.

    Rows are numbered within their virtual slot and shifted by the rows of the
    slots before it in the shard, so no task holds a shard.
    """
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    starts = table.select("virtual_slot", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.join(F.broadcast(starts), "virtual_slot").withColumn("slot", (F.col("start") + within - 1).cast("long")).drop("start")


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, before: DataFrame | None = None, version: int = 0) -> DataFrame:
    """Put every row of ``docs`` into one of ``shards`` shards of near equal bytes.

    Size is the UTF-8 bytes of the text (null: none) plus 1. Rows with equal
    doc_id share a virtual slot; rows that are wholly repeated each get a place.
    Other columns are not read. An empty table gives an empty result.
    """
    rows = written(sized(docs, slots), "sized")
    table = written(slot_map(slot_bytes(rows), shards, before, version, slots), f"slot-map-v{version}")
    return place(rows, table)


def shard_and_grow(docs: DataFrame, shards: int = 8, slots: int = SLOTS) -> DataFrame:
    """What ``shard`` gives, with the edit of the map that takes in one more shard.

    ``next_shard`` and ``next_version`` are those of the edited map: only slots over
    an even share of its shard's bytes have another shard there.
    """
    rows = written(sized(docs, slots), "sized")
    table = written(slot_map(slot_bytes(rows), shards, slots=slots), "slot-map-v0")
    edited = slot_map(table.select("virtual_slot", "bytes", "rows"), shards + 1, table, 1, slots)
    named = edited.select("virtual_slot", F.col("shard").alias("next_shard"), F.col("version").alias("next_version"))
    return place(rows, table).join(F.broadcast(named), "virtual_slot")


def write_shards(docs: DataFrame, table: DataFrame, path: str, slots: int = SLOTS) -> str:
    """Write ``docs`` with all columns under ``path``, in a folder a shard, by the map ``table``, with no shuffle.

    Returns the name of the partition column: shard, with underscores before it
    where ``docs`` has that already. The map has all slots, so rows of slots that
    were empty when it was made are written, too.
    """
    slot, shard = unused(docs, "virtual_slot", "shard")
    named = table.select(F.col("virtual_slot").alias(slot), F.col("shard").alias(shard))
    placed = docs.withColumn(slot, virtual_slot(slots)).join(F.broadcast(named), slot)
    placed.drop(slot).write.partitionBy(shard).mode("overwrite").parquet(path)
    return shard
