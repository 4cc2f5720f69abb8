"""The trie of conversation prefixes, from sorted conversations.

Distinct conversations are sorted by the digests of their turns and numbered in
blocks. The lengths of common prefixes of neighbours (LCP) form a Cartesian tree,
whose nodes are found by all-nearest-smaller-values: each block settles its own by a
stack that merges equal values, and what it leaves open is looked up in the block
that the minima of all blocks point to. A node is an interval of the sorted
conversations; depths that no branching shows are filled in between it and its
parent, and what a node counts is a difference of running sums at its two ends.

Composite positions number the conversations of a block after those of the blocks
before it; only their order matters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, written

#: Conversations borrow their start from the first of so many neighbours, at most so many turns less one.
FAMILY = 5
BORROWED = 9
#: Ids that one part of a list of ids holds.
IDS = 50_000

_BLOCK = 33  # monotonically_increasing_id has the partition above these bits
_HEX = 32  # hexadecimal digits of a turn's digest


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest of role and text, bytes of the text; turns in order of turn (null first), ties by digest."""
    role, text = text_or_empty("role"), text_or_empty("text")
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, _HEX)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    own = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.withColumn("pos", F.row_number().over(own) - 1).drop("turn")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with a start from the first of its family: conv_id, seq (digests), bytes (of each turn), key (of all)."""
    rows = written(turns(conversations), "turns")
    base, borrowed = F.col("conv_id") - F.col("conv_id") % FAMILY, F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    each = F.struct("part", "pos", "digest", "bytes")
    own = rows.withColumn("part", F.lit(1)).select("conv_id", F.when(F.col("pos") >= borrowed, each).alias("turn"))
    convs = rows.select("conv_id").distinct().select("conv_id", base.alias("base"), borrowed.alias("h"))
    starts = rows.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < BORROWED - 1)).withColumnRenamed("conv_id", "base").withColumn("part", F.lit(0))
    lent = convs.join(starts, "base").filter(F.col("pos") < F.col("h")).select("conv_id", each.alias("turn"))
    whole = own.unionByName(lent).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return whole.select("conv_id", F.col("turns.digest").alias("seq"), F.col("turns.bytes").alias("bytes"), F.sha2(F.array_join("turns.digest", ""), 256).alias("key"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, conv_id), runs of ids of one key as text: key, first, ids."""
    for batch in batches:
        keys, ids, out, start = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[start] or k - start == IDS:
                out.append((keys[start], ids[start], ",".join(map(str, ids[start:k]))))
                start = k
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=["key", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, first, ids), the SHA-256 of each key's ids: only the state of one hash is held."""
    at, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.string())], names=["key", "ends_sha256"])

    for batch in batches:
        done = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if key == at:
                state.update(b",")
            else:
                if at is not None:
                    done.append((at, state.hexdigest()))
                at, state = key, hashlib.sha256()
            state.update(ids.encode())
        yield row()
    if at is not None:
        done = [(at, state.hexdigest())]
        yield row()


def id_digests(convs: DataFrame) -> DataFrame:
    """For each key the SHA-256 of its conv_ids, ascending and comma-joined.

    Ranges of (key, conv_id) turn into text apart from each other, so one key's ids
    may be any share of all; then one task passes over a key's text as a stream.
    """
    parts = convs.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_parts, "key string, first long, ids string")
    return parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, ends_sha256 string")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to sorted conversations the common prefix with the one before in the partition (null for the first), its bytes, the length and all bytes."""
    before = None
    for batch in batches:
        lcp, shared, length, total = [], [], [], []
        for seq, n in zip(batch.column("seq").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
            same = None
            if before is not None:
                same = next((k for k, (x, y) in enumerate(zip(before, seq, strict=False)) if x != y), min(len(before), len(seq)))
            lcp.append(same)
            shared.append(None if same is None else sum(n[:same]))
            length.append(len(seq))
            total.append(sum(n))
            before = seq
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in (lcp, shared, length, total))], names=[*batch.schema.names, "lcp", "shared", "length", "total"])


def _block() -> Column:
    return F.shiftrightunsigned("idx", _BLOCK)


def ordered(convs: DataFrame) -> DataFrame:
    """Distinct sequences of ``convs`` in order: idx, conv_id (smallest), n, ends_sha256, seq, bytes, and what _neighbours adds."""
    groups = convs.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).join(id_digests(convs), "key")
    distinct = convs.join(groups, ["key", "conv_id"]).select("conv_id", "n", "ends_sha256", "seq", "bytes")
    in_order = distinct.repartitionByRange("seq").sortWithinPartitions("seq").withColumn("idx", F.monotonically_increasing_id())
    return in_order.mapInArrow(_neighbours, "conv_id long, n long, ends_sha256 string, seq array<string>, bytes array<long>, idx long, lcp long, shared long, length long, total long")


def first_of_blocks(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """For each block the common prefix of its first conversation with the last of the block before, and the bytes of that.

    The driver gets a row a block, which is a partition of the sort.
    """
    blocks = sorted((r["block"], r["last"]) for r in rows.groupBy(_block().alias("block")).agg(F.max("idx").alias("last")).collect())
    if not blocks:
        return {}
    spark, out = rows.sparkSession, {blocks[0][0]: (-1, 0)}
    if len(blocks) > 1:
        pairs = spark.createDataFrame([(b << _BLOCK, last) for (b, _), (_, last) in zip(blocks[1:], blocks, strict=False)], "idx long, last long")
        first = rows.select("idx", "seq", "bytes").join(F.broadcast(pairs), "idx")
        both = first.join(rows.select(F.col("idx").alias("last"), F.col("seq").alias("other")), "last")
        same = F.array_position(F.zip_with("seq", "other", lambda x, y: x.eqNullSafe(y)), False) - 1
        held = both.select(_block().alias("block"), same.alias("lcp"), "bytes")
        shared = F.expr("aggregate(slice(bytes, 1, CAST(lcp AS int)), 0L, (a, x) -> a + x)")
        out |= {r["block"]: (r["lcp"], r["shared"]) for r in held.select("block", "lcp", shared.alias("shared")).collect()}
    return out


# a place between conversations: the LCP there, its position, and running sums over the block before it
_SUMS = ("n", "leaves", "weight", "fresh")
_PLACE = pa.struct([("lcp", pa.int64()), ("idx", pa.int64()), *((c, pa.int64()) for c in _SUMS)])
_PLACE_SQL = "struct<lcp:long,idx:long,n:long,leaves:long,weight:long,fresh:long>"
NODE, SUFFIX, PREFIX, TOTAL = range(4)
_OUT = f"kind int, block long, depth long, equal long, conv_id long, l {_PLACE_SQL}, r {_PLACE_SQL}"


class _Scan:
    """The stack over one block: entries of strictly increasing LCP, each [lcp, left place or None, last place of that LCP, smallest conv_id, how many places have the LCP]."""

    def __init__(self, block: int, out: list) -> None:
        self.block, self.out, self.stack = block, out, []
        self.sums = [0, 0, 0, 0]
        self.place, self.conv, self.length, self.lowest, self.smallest = None, None, None, None, None

    def emit(self, kind: int, depth: int, equal: int, conv: int | None, left: tuple | None, right: tuple | None) -> None:
        self.out.append((kind, self.block, depth, equal, conv, left, right))

    def _leave(self, lcp: int, at: int) -> tuple:
        """Ends the conversation before ``at``, whose next neighbour has ``lcp`` in common with it."""
        if self.place is not None:
            self.sums[1] += self.length > lcp
            place = (lcp, at, *self.sums)
            if self.length > max(lcp, self.place[0]):
                self.emit(NODE, self.length, 0, self.conv, self.place, place)
            return place
        return (lcp, at, *self.sums)

    def add(self, idx: int, lcp: int, conv: int, n: int, length: int, weight: int, fresh: int) -> None:
        place = self._leave(lcp, idx)
        left, smallest = self.place, self.conv
        while self.stack and self.stack[-1][0] > lcp:
            depth, left, _, own, equal = self.stack.pop()
            smallest = min(own, smallest) if own is not None else smallest
            self.emit(NODE, depth, equal, smallest, left, place)
        if not self.stack and (self.lowest is None or lcp < self.lowest):
            self.emit(PREFIX, lcp, 0, smallest, None, place)
            self.lowest = lcp
        if self.stack and self.stack[-1][0] == lcp:
            top = self.stack[-1]
            top[2], top[3], top[4] = place, smallest if top[3] is None else min(top[3], smallest), top[4] + 1
        else:
            self.stack.append([lcp, left, place, smallest, 1])
        self.place, self.conv, self.length = place, conv, length
        self.smallest = conv if self.smallest is None else min(conv, self.smallest)
        for k, x in ((0, n), (2, weight), (3, fresh)):
            self.sums[k] += x

    def end(self, lcp: int) -> None:
        """The block ends; the next one's first conversation has ``lcp`` in common with the last here."""
        place = self._leave(lcp, self.place[1] + 1)
        smallest = self.conv
        for depth, left, last, own, equal in reversed(self.stack):
            self.emit(SUFFIX, depth, 0, smallest, last, None)
            smallest = smallest if own is None else min(own, smallest)
            if depth >= 0:
                self.emit(NODE, depth, equal, smallest, left, None)
        self.emit(TOTAL, self.lowest, 0, self.smallest, None, place)


def _scan(first: dict[int, tuple[int, int]]):
    blocks = sorted(first)
    following = {b: first[c][0] for b, c in zip(blocks, blocks[1:], strict=False)}

    def batch(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.int32(), *[pa.int64()] * 4]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
        names = [f.name for f in _PLACE]
        arrays += [pa.array([None if x is None else dict(zip(names, x, strict=True)) for x in c], _PLACE) for c in columns[5:]]
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "block", "depth", "equal", "conv_id", "l", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        scan = None
        for part in batches:
            for idx, lcp, shared, conv, n, length, total in zip(*(part.column(c).to_pylist() for c in ("idx", "lcp", "shared", "conv_id", "n", "length", "total")), strict=True):
                block = idx >> _BLOCK
                if scan is None or scan.block != block:
                    if scan is not None:
                        scan.end(following.get(scan.block, -1))
                    scan = _Scan(block, out)
                if lcp is None:
                    lcp, shared = first[block]
                scan.add(idx, lcp, conv, n, length, n * total, total - shared)
            yield batch(out)
            out.clear()
        if scan is not None:
            scan.end(following.get(scan.block, -1))
            yield batch(out)

    return run


def _targets(blocks: list[int], lowest: list[int], smallest: list[int]):
    """Adds to open nodes the blocks that hold their ends (the last number for the end of all), and the smallest conv_id of the blocks between."""
    at = {b: k for k, b in enumerate(blocks)}
    low, small = np.array(lowest), np.array(smallest)

    def nearest_smaller(values: np.ndarray) -> list[int]:
        found, stack = [], []
        for k, v in enumerate(values):
            while stack and values[stack[-1]] >= v:
                stack.pop()
            found.append(stack[-1] if stack else -1)
            stack.append(k)
        return found

    count = len(blocks)
    before = nearest_smaller(low)
    after = [count - 1 - k for k in reversed(nearest_smaller(low[::-1]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, between = [], [], []
            for block, depth, has_l, has_r in zip(*(batch.column(c).to_pylist() for c in ("block", "depth", "has_l", "has_r")), strict=True):
                k = at[block]
                a, b, least = None, None, []
                if not has_l:
                    a = k - 1
                    while low[a] >= depth:
                        a = before[a]
                    least += small[a + 1 : k].tolist()
                if not has_r:
                    b = k + 1
                    while b < count and low[b] >= depth:
                        b = after[b]
                    least += small[k + 1 : b].tolist()
                left.append(None if a is None else blocks[a])
                right.append(None if b is None or b == count else blocks[b])
                between.append(min(least, default=None))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in (left, right, between))], names=[*batch.schema.names, "left", "right", "between"])

    return run


def compressed(rows: DataFrame) -> DataFrame:
    """Nodes of the compressed trie over ``ordered`` rows: idx (of its first conversation), lcp (of that with the one before), depth, up (its parent's depth), conv_id, equal (places that split it), n, leaves, weight, fresh."""
    first = first_of_blocks(rows)
    slim = rows.select("idx", "lcp", "shared", "conv_id", "n", "length", "total")
    scanned = written(slim.repartition(max(1, len(first)), _block()).sortWithinPartitions("idx").mapInArrow(_scan(first), _OUT), "blocks")
    lcp, up = F.col("l.lcp").alias("lcp"), F.greatest("l.lcp", "r.lcp").alias("up")
    nodes = scanned.filter(F.col("kind") == NODE)
    inside = nodes.filter(F.col("l").isNotNull() & F.col("r").isNotNull())
    closed = inside.select(F.col("l.idx").alias("idx"), lcp, "depth", up, "conv_id", "equal", *((F.col(f"r.{c}") - F.col(f"l.{c}")).alias(c) for c in _SUMS))
    totals = sorted(scanned.filter(F.col("kind") == TOTAL).select("block", "depth", "conv_id", "r").collect())  # a row a block
    if not totals:
        return closed
    spark = rows.sparkSession
    sums = [list(accumulate((t["r"][c] for t in totals), initial=0)) for c in _SUMS]
    offsets = spark.createDataFrame([(t["block"], *(int(s[k]) for s in sums)) for k, t in enumerate(totals)], "at long, " + ", ".join(f"{c}_off long" for c in _SUMS))
    crossing = nodes.filter(F.col("l").isNull() | F.col("r").isNull()).withColumns({"has_l": F.col("l").isNotNull(), "has_r": F.col("r").isNotNull()})
    find = _targets([t["block"] for t in totals], [t["depth"] for t in totals], [t["conv_id"] for t in totals])
    aimed = crossing.mapInArrow(find, _OUT + ", has_l boolean, has_r boolean, left long, right long, between long")

    def stairs(kind: int, place: str, by: str) -> DataFrame:
        """The places of a block that may end a node of another: as many as there are depths."""
        steps = scanned.filter(F.col("kind") == kind).groupBy(F.col("block").alias(by))
        return steps.agg(F.collect_list(F.struct(F.col("depth").alias("lcp"), F.col(place).alias("place"), F.col("conv_id").alias("conv"))).alias(f"{by}_steps"))

    both = aimed.join(stairs(SUFFIX, "l", "left"), "left", "left").join(stairs(PREFIX, "r", "right"), "right", "left")
    for side in ("left", "right"):
        both = both.withColumn(side, F.expr(f"array_max(filter({side}_steps, s -> s.lcp < depth))")).drop(f"{side}_steps")
    last = F.struct(F.lit(-1).cast("long").alias("lcp"), F.lit((totals[-1]["block"] + 1) << _BLOCK).cast("long").alias("idx"), *(F.lit(int(totals[-1]["r"][c])).cast("long").alias(c) for c in _SUMS))
    ended = both.select(
        "depth",
        "equal",
        F.least("conv_id", "between", "left.conv", "right.conv").alias("conv_id"),
        F.coalesce("l", "left.place").alias("l"),
        F.coalesce("r", "right.place", last).alias("r"),
        # the end of all counts from the last block's start
        F.coalesce("r.idx", "right.place.idx", F.lit(totals[-1]["block"] << _BLOCK)).alias("r_idx"),
    )
    for side, idx in (("l", "l.idx"), ("r", "r_idx")):
        off = F.broadcast(offsets.select("at", *(F.col(f"{c}_off").alias(f"{side}_{c}") for c in _SUMS)))  # a row a block
        ended = ended.join(off, F.shiftrightunsigned(idx, _BLOCK) == F.col("at")).drop("at")
    found = ended.select(F.col("l.idx").alias("idx"), F.col("r.idx").alias("end"), lcp, "depth", up, "conv_id", "equal", *((F.col(f"r.{c}") + F.col(f"r_{c}") - F.col(f"l.{c}") - F.col(f"l_{c}")).alias(c) for c in _SUMS))
    merged = found.groupBy("idx", "end", "lcp", "depth", "up", "conv_id", *_SUMS).agg(F.sum("equal").alias("equal")).drop("end")
    return closed.unionByName(merged)


_NODES = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, parent_conv_id long, own string, parent string"
_NOBODY = hashlib.sha256(b"").hexdigest()


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of compressed nodes with their first conversation, a row for each depth from below the parent on."""
    names = [x.split()[0] for x in _NODES.split(", ")]
    kinds = [pa.string() if "string" in x else pa.int64() for x in _NODES.split(", ")]
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            seq, depth, up = r["seq"], r["depth"], r["up"]
            total = [0, *accumulate(r["bytes"])]
            shared = total[max(r["lcp"], 0)]
            for d in range(up + 1, depth + 1):
                above = total[max(d - 1, 0)]
                saved = r["weight"] - r["n"] * above - (r["fresh"] + shared - above)
                children = 1 if d < depth else r["equal"] and r["equal"] + 1 - (len(seq) == depth)
                own = _prefix(seq, d) if d == depth and r["equal"] else None
                parent = _prefix(seq, up) if d == up + 1 and up >= 0 else None
                out.append((r["conv_id"], d, r["n"], children, r["leaves"], saved, r["ends_sha256"] if d == len(seq) else _NOBODY, r["conv_id"] if d > up + 1 else None, own, parent))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def _prefix(seq: list[str], depth: int) -> str:
    return hashlib.sha256("".join(seq[:depth]).encode()).hexdigest()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with what it would save to read it once.

    A conversation is the first h turns of its family's first, then its own from the
    h-th on. Null roles and texts are empty; null turns come first and equal ones are in
    order of a digest, so repeated rows are turns of their own; rows without a conv_id
    belong to no conversation and are left out. A turn of any length is 32 digits here, and
    a conversation's digits are one row. Other columns are not read, and an empty table gives
    an empty result, without a root.

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    rows = written(ordered(written(rebuilt(conversations), "rebuilt")), "ordered")
    nodes = written(compressed(rows).join(rows.select("idx", "seq", "bytes", "ends_sha256"), "idx").mapInArrow(_expand, _NODES), "nodes")
    return _with_parents(nodes)


def _with_parents(nodes: DataFrame) -> DataFrame:
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = nodes.filter("own IS NOT NULL").select(F.col("own").alias("parent"), F.col("conv_id").alias("found"))
    below = nodes.filter("parent IS NOT NULL").join(parents, "parent").withColumn("parent_conv_id", F.col("found"))
    return nodes.filter("parent IS NULL").select(columns).unionByName(below.select(columns))
