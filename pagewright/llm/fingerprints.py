"""SimHash fingerprints of whole texts, and a search within a Hamming radius.

Every word of a text votes on 128 signed bits with the bits of its hash and the
weight of its length. Fingerprints within a radius are found by tables of block
choices: of radius + SHARED blocks at least SHARED agree, and each choice of
SHARED blocks is a table that is joined on them. All of this is DataFrame
operations: votes are sums of packed lanes, a document's next one comes from one
window over ranges of ids, blocks are masks on two longs.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import SPACE, text_or_empty, written

BITS = 128
#: Documents in a range of ids, about, and ranges at most; both bound what one window holds.
RANGE = 3000
RANGES = 1 << 20
#: Cut points that are estimated; ranges between two of them are cut evenly.
CUTS = 256

#: Bits that fingerprints of a search may differ in, and blocks that then still agree for certain.
RADIUS = 6
SHARED = 2
#: Documents whose id this divides are the queries of a search.
EVERY = 20
#: A key of a block table is dealt out in parts of about so many queries, where it has more.
PART = 200
#: Keys, and fingerprints, that are dealt out by a broadcast table: no more can be above a share of 1 / HOT.
HOT = 1 << 16

_LANES = (1 << 32) | 1


def weight(word: Column) -> Column:
    """Long words are rarer: the square of the length, up to 8."""
    return F.pow(F.least(F.length(word), F.lit(8)), F.lit(2)).cast("long")


def _votes(word: Column) -> list[Column]:
    """For each bit i below 32 of the two hashes, the sums for bits i and i + 32, packed in one long."""
    hashes = (F.xxhash64(word), F.xxhash64(F.lit("second"), word))
    return [F.sum(weight(word) * F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES))).alias(f"v{k}_{i}") for k, h in enumerate(hashes) for i in range(32)]


def _signs(k: int) -> Column:
    """64 bits of the fingerprint, as a long: those with more than half of the weight."""
    out = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"v{k}_{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"v{k}_{i}"), 32)
        for at, ones in ((i, low), (i + 32, high)):
            out = out.bitwiseOR(F.when(ones * 2 > F.col("votes"), F.shiftleft(F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long")))
    return out


def _string(first: str, second: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(first), 16, "0"), F.lpad(F.hex(second), 16, "0")))


def simhash(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for each ``keys`` with the fingerprint of ``text`` as longs f0 and f1. Rows with equal keys vote together."""
    words = rows.select(*keys, F.explode(F.split(F.col(text), SPACE)).alias("_word"))
    sums = words.groupBy(*keys).agg(F.sum(weight(F.col("_word"))).alias("votes"), *_votes(F.col("_word")))
    return sums.select(*keys, _signs(0).alias("f0"), _signs(1).alias("f1"))


def _likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    apart = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)), F.lit(0))
    return (1 - apart / F.lit(BITS)).cast("double")


def _ranges(ids: DataFrame) -> tuple[Column, int]:
    """An expression for the range of ``_id``, rising with it, and how many there are; from the count and estimated quantiles."""
    n = ids.count()
    ranges = min(RANGES, max(1, n // RANGE))
    if ranges == 1:
        return F.lit(0), 1
    cuts = min(CUTS, ranges)
    even = -(-ranges // cuts)
    found = ids.agg(F.min("_id").alias("low"), F.max("_id").alias("high"), F.percentile_approx("_id", [k / cuts for k in range(1, cuts)] or [0.5], 10_000).alias("cuts")).first()
    edges = sorted({found["low"], *found["cuts"], found["high"] + 1})
    lower = F.array(*(F.lit(e) for e in edges))
    at = F.greatest(F.size(F.filter(lower, lambda e: e <= F.col("_id"))), F.lit(1))
    low, high = F.element_at(lower, at), F.coalesce(F.try_element_at(lower, at + 1), F.lit(edges[-1] + 1))
    part = F.least(F.floor((F.col("_id") - low) * even / F.greatest(high - low, F.lit(1))).cast("int"), F.lit(even - 1))
    return at * even + part, ranges


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars and the next document's text, by descending doc_id; after the last comes the first.

    A null doc_id comes after all others, by a hash of its text, and so do equal
    doc_id among themselves. The first document of a range is also put at the end
    of the range above it, as a guard that is marked and does not count.
    """
    text = text_or_empty()
    hashed = F.xxhash64(text)
    # rows without an id are spread below all ids
    pseudo = F.lit(-(1 << 62)) - F.shiftrightunsigned(hashed, 2)
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), pseudo).alias("_id"))
    place, _ = _ranges(rows.select("_id"))
    placed = rows.withColumn("_range", place)
    tops = placed.groupBy("_range").agg(F.max("_id").alias("_top"))  # at most RANGES rows
    order = W.orderBy("_range")
    first = F.max("_top").over(W.partitionBy())
    guards = tops.select(F.coalesce(F.lag("_top").over(order), first).alias("_id"), F.col("_range").alias("_above"))
    both = F.expr("inline(IF(_above IS NULL, array(struct(_range AS r, false AS guard)), array(struct(_range AS r, false AS guard), struct(_above AS r, true AS guard))))")
    dealt = placed.join(F.broadcast(guards), "_id", "left").select("doc_id", "text", "_id", both)
    near = W.partitionBy("r").orderBy("guard", F.desc("_id"), F.xxhash64("text"), "text")
    return dealt.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), "r", "guard", F.row_number().over(near).alias("at"), F.lead("text").over(near).alias("next_text"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row's whole text and of its edited text, and their likeness.

    A null text is empty. The edited text has its last third (n_chars / 3, rounded
    down) replaced by as many first characters of the next document's text.
    Equal texts have equal fingerprints; one without words has all bits 0. Rows
    that are wholly repeated are each other's neighbours. Other columns are not
    read. An empty table gives an empty result.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (32
    hexadecimal digits), near_edited, near_next.
    """
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    rows = with_next(docs).withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    two = rows.select("r", "at", "guard", "doc_id", "n_chars", "edited_sha256", F.expr("inline(array(struct(0 AS kind, text AS body), struct(1 AS kind, edited AS body)))"))
    own = ["r", "at", "guard", "doc_id", "n_chars", "edited_sha256"]
    hashed = simhash(two, [*own, "kind"], "body")
    pick = lambda kind, f: F.max(F.when(F.col("kind") == kind, F.col(f))).alias(f"{'te'[kind]}{f[1]}")
    wide = hashed.groupBy(*own).agg(*(pick(kind, f) for kind in (0, 1) for f in ("f0", "f1")))
    order = W.partitionBy("r").orderBy("at")
    nexts = {f"n{k}": F.lead(f"t{k}").over(order) for k in (0, 1)}
    return (
        wide.withColumns(nexts)
        .filter("NOT guard")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            _string("t0", "t1").alias("fingerprint"),
            _string("e0", "e1").alias("edited_fingerprint"),
            _likeness(("t0", "t1"), ("e0", "e1")).alias("near_edited"),
            _likeness(("t0", "t1"), ("n0", "n1")).alias("near_next"),
        )
    )


def _longs(fingerprint: str = "fingerprint") -> list[Column]:
    return [F.conv(F.substring(fingerprint, 1 + 16 * k, 16), 16, -10).cast("long").alias(f"f{k}") for k in (0, 1)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def block_masks(radius: int = RADIUS, shared: int = SHARED) -> list[tuple[int, int]]:
    """For each choice of ``shared`` of radius + shared blocks, its bits in the two longs of a fingerprint."""
    blocks = radius + shared
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    bits = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    chosen = [sum(c) for c in combinations(bits, shared)]
    return [(_signed(m >> 64), _signed(m & ((1 << 64) - 1))) for m in chosen]


def _keyed(df: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """``df`` (f0, f1) once for each block table, with its number and key there."""
    keys = [F.struct(F.lit(n).alias("_table"), F.xxhash64(F.lit(n), F.col("f0").bitwiseAND(F.lit(a)), F.col("f1").bitwiseAND(F.lit(b))).alias("_key")) for n, (a, b) in enumerate(masks)]
    return df.select("*", F.inline(F.array(*keys)))


def within(queries: DataFrame, rows: DataFrame, radius: int = RADIUS, shared: int = SHARED) -> DataFrame:
    """Each row of ``rows`` (distinct f0, f1 and more) beside each of ``queries`` (distinct f0, f1) within ``radius`` bits, itself too.

    Returns q0, q1, the columns of ``rows`` and distance. A pair is given by the
    first of the tables in which it meets, so none comes twice. A key with many
    queries is dealt out: its queries go to all parts, each row to one.
    """
    masks = block_masks(radius, shared)
    asked = _keyed(queries.select("f0", "f1"), masks).withColumnsRenamed({"f0": "q0", "f1": "q1"})
    least = max(PART, queries.count() * len(masks) // HOT)
    often = asked.groupBy("_key").agg(F.ceil(F.count("*") / PART).cast("int").alias("_parts"), F.count("*").alias("_n")).filter(F.col("_n") > least).select("_key", "_parts")
    parts = F.coalesce("_parts", F.lit(1))
    to_all = asked.join(F.broadcast(often), "_key", "left").select("_key", "q0", "q1", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    to_one = _keyed(rows, masks).join(F.broadcast(often), "_key", "left").withColumn("_part", F.pmod(F.xxhash64("f0", "f1"), parts).cast("int")).drop("_parts")
    x0, x1 = F.col("q0").bitwiseXOR(F.col("f0")), F.col("q1").bitwiseXOR(F.col("f1"))
    meets = F.coalesce(*(F.when(x0.bitwiseAND(F.lit(a)).bitwiseOR(x1.bitwiseAND(F.lit(b))) == 0, n) for n, (a, b) in enumerate(masks)))
    near = to_all.join(to_one, ["_key", "_part"]).withColumn("distance", F.bit_count(x0) + F.bit_count(x1)).filter(F.col("distance") <= radius)
    return near.filter(F.col("_table") == meets).select("q0", "q1", *rows.columns, "distance")


def search(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, shared: int = SHARED) -> DataFrame:
    """All fingerprints within ``radius`` bits of those of ``queries``: fingerprint, near, distance.

    Both inputs have a column fingerprint; distinct ones stand for all their
    documents, and null ones are near none.
    """
    own = [df.filter("fingerprint IS NOT NULL").select(*_longs()).distinct() for df in (queries, fingerprints)]
    return within(*own, radius, shared).select(_string("q0", "q1").alias("fingerprint"), _string("f0", "f1").alias("near"), "distance")


def neighbours(prints: DataFrame, radius: int = RADIUS, every: int = EVERY) -> DataFrame:
    """``prints`` (doc_id, fingerprint and more) with what a search finds for documents whose id ``every`` divides.

    Added are near_fingerprints (other fingerprints within ``radius`` bits),
    near_docs (other documents within it, equal fingerprints counted) and nearest
    (likeness of the nearest other fingerprint within it, else null); for all other
    rows, and those with a null doc_id, all three are null. Every row is searched.
    A query and a fingerprint are compared once a key they share, so the work in a
    group of near copies is its queries times its different fingerprints; documents
    with equal ones cost nothing more. The caller gives a table that can be read
    several times.
    """
    rows = prints.withColumn("_asked", F.coalesce(F.pmod(F.col("doc_id"), F.lit(every)) == 0, F.lit(False))).select("*", *_longs())
    classes = written(rows.groupBy("f0", "f1").agg(F.count("*").alias("docs"), F.max("_asked").alias("_asked")), "fingerprints")
    pairs = within(classes.filter("_asked"), classes.select("f0", "f1", "docs"), radius)
    other = F.col("distance") > 0
    found = pairs.groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1")).agg(
        F.count(F.when(other, 1)).alias("near_fingerprints"),
        (F.sum("docs") - 1).alias("near_docs"),
        (1 - F.min(F.when(other, F.col("distance"))) / F.lit(BITS)).cast("double").alias("nearest"),
        F.max(F.when(~other, F.col("docs"))).alias("_docs"),
    )
    found, names = written(found, "neighbours"), ["near_fingerprints", "near_docs", "nearest"]
    # what many documents share is broadcast, and those are then dealt out by id
    many = F.col("_docs") > rows.count() // HOT + PART
    hot = found.filter(many).select("f0", "f1", F.struct(*names).alias("_hot"))
    rest = found.filter(~many).select(F.col("f0").alias("_f0"), F.col("f1").alias("_f1"), F.struct(*names).alias("_rest"))
    asked = rows.filter("_asked").join(F.broadcast(hot), ["f0", "f1"], "left").withColumn("_spread", F.when(F.col("_hot").isNull(), F.col("f1")).otherwise(F.xxhash64("doc_id")))
    met = asked.join(rest, (F.col("f0") == F.col("_f0")) & (F.col("_spread") == F.col("_f1")), "left")
    got = F.coalesce("_hot", "_rest")
    told = met.select(*prints.columns, *(got[n].alias(n) for n in names))
    silent = rows.filter("NOT _asked").select(*prints.columns, *(F.lit(None).cast(t).alias(n) for n, t in zip(names, ("long", "long", "double"), strict=True)))
    return told.unionByName(silent)
