"""Packing token sequences into as few bins as possible, by their lengths alone.

What matters to a plan is how many pieces there are of each length, at most
4096 numbers. Pairs that fill a sequence exactly, and pieces that nothing fits
beside, dominate every other way to place their members: they are fixed first
(Martello and Toth). The shrunk rest goes best-fit, longest first. The plan is
broadcast; which piece takes which place of it is settled by salted ranks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, written
from pagewright.llm.tokens import encoder, tokenizer_path

CAPACITY = 4096
#: The id that ends a document.
END = 1
#: Ranks within one length are counted in so many salted parts.
SALTS = 256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, with_ids: bool):
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part))
                    held += len(part)
                if held > 16_000_000:
                    yield _batch(rows, with_ids)
                    rows, held = [], 0
            yield _batch(rows, with_ids)

    return run


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    arrays = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)]
    names = [n for n, _ in kinds]
    if with_ids:
        ids = pa.array([np.frombuffer(r[5], "<u4").astype("<i4") for r in rows], pa.list_(pa.int32()))
        arrays, names = [*arrays, ids], [*names, "ids"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def tokenized_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's ids and END, cut every ``capacity`` ids: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    schema = PIECES + (", ids array<int>" if with_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_pieces(path or tokenizer_path(), capacity, with_ids), schema)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets of one or two lengths that can be fixed without loss, with how often, and what is left.

    For a length v, let w be the longest length left that fits beside one of v.
    No w: {v} alone. v + w full, or no two pieces fit beside v together: {v, w}
    dominates, as whatever else could lie beside v fits into the place of w.
    """
    left = {v: n for v, n in counts.items() if n > 0}
    lengths = sorted(left)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(v: int, n: int) -> None:
        left[v] -= n
        if not left[v]:
            del left[v]
            lengths.pop(bisect_left(lengths, v))

    for v in sorted(left, reverse=True):
        while v in left:
            left[v] -= 1  # the piece in hand
            k = bisect_left(lengths, capacity - v + 1) - 1
            while k >= 0 and not left[lengths[k]]:
                k -= 1
            smallest = [x for x in lengths[:3] for _ in range(min(2, left[x]))][:2]
            left[v] += 1
            if k < 0:
                n = 1 if 2 * v <= capacity else left[v]
                fixed.append(((v,), n))
                take(v, n)
                continue
            w = lengths[k]
            if v + w != capacity and len(smallest) == 2 and v + sum(smallest) <= capacity:
                break
            n = left[v] // 2 if v == w else min(left[v], left[w])
            if v + w != capacity and w == smallest[0]:
                n = 1  # what is smallest may change with each step
            fixed.append(((v, w), n))
            take(v, 2 * n if v == w else n)
            if v != w:
                take(w, n)
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit, longest first, of many pieces a length at once: patterns ((length, times), ...) and how often each occurs.

    Bins that look alike are one entry, so the work follows the number of lengths.
    """
    open_bins: dict[int, list[tuple[tuple, int]]] = {}
    rooms: list[int] = []
    done: list[tuple[list[tuple[int, int]], int]] = []

    def put(pattern: tuple, n: int, room: int) -> None:
        if n and room:
            if room not in open_bins:
                insort(rooms, room)
            open_bins.setdefault(room, []).append((pattern, n))
        elif n:
            done.append((pattern, n))

    for v in sorted(counts, reverse=True):
        n = counts[v]
        while n:
            at = bisect_left(rooms, v)
            if at == len(rooms):  # new bins
                room, pattern, bins = capacity, (), -(-n // (capacity // v))
            else:
                room = rooms[at]
                pattern, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            times = room // v
            full = min(bins, n // times)
            put((*pattern, (v, times)), full, room - times * v)
            n -= full * times
            bins -= full
            if bins and n:
                put((*pattern, (v, n)), 1, room - n * v)
                n, bins = 0, bins - 1
            if pattern:
                put(pattern, bins, room)
    for room in rooms:
        done.extend(open_bins[room])
    return done


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Places by length: sorted arrays of (length, first rank) and, for each, the first sequence, times a sequence, and first offset."""
    fixed, left = reduce_by_dominance(counts, capacity)
    patterns = [([(lengths[0], len(lengths))] if len(set(lengths)) == 1 else [(v, 1) for v in lengths], n) for lengths, n in fixed]
    patterns += best_fit(left, capacity)
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for v, times in pattern:
            rows.append((v, rank.get(v, 0), sequence, times, offset))
            rank[v] = rank.get(v, 0) + times * n
            offset += v * times
        sequence += n
    assert rank == {v: n for v, n in counts.items() if n}, "a plan must place every piece"
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {k: table[:, i] for i, k in enumerate(("length", "rank", "sequence", "times", "offset"))}


def _placed(spark, places: dict[str, np.ndarray]):
    sent = spark.sparkContext.broadcast(places)

    @F.arrow_udf("sequence_id long, offset long")
    def lookup(length: pa.Array, rank: pa.Array) -> pa.Array:
        p = sent.value
        first = np.searchsorted(p["length"], np.arange(p["length"][-1] + 2))  # where each length's places begin
        v, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        key = p["length"] * (1 << 44) + p["rank"]
        at = np.maximum(np.searchsorted(key, v * (1 << 44) + r, side="right") - 1, first[v])
        within = r - p["rank"][at]
        found = (p["sequence"][at] + within // p["times"][at], p["offset"][at] + within % p["times"][at] * v)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=["sequence_id", "offset"])

    return lookup


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with doc_id, piece, ids_crc32, length of 1 to ``capacity``) with sequence_id and offset."""
    spark = pieces.sparkSession
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    parts = written(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "lengths")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    earlier = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    within = F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.join(bases, ["length", "_salt"]).withColumn("_rank", (F.col("_base") + within).cast("long"))
    place = _placed(spark, plan(counts, capacity))("length", "_rank")
    return ranked.withColumn("_place", place).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack every document of ``docs`` into sequences of at most ``capacity`` ids.

    A document is its ids and END; a null or empty text is END alone. Only a
    document that is longer than ``capacity`` is cut. Repeated rows are packed
    each; other columns are not read. An empty table gives an empty result.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32,
    (ids,) sequence_id, offset.
    """
    return pack_pieces(written(tokenized_pieces(docs, path, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id, ids, doc_ids in their order."""
    part = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(part.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
