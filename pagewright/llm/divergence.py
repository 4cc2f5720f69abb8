"""How far the sources of a language lie apart in their words, by plain relational steps.

Matches of a term are exploded and counted, groups are crossed with the kept
vocabulary of their language so that a missing term counts as zero, and a
self-join on language and term sums the divergence of each two sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, written

#: A term: a run of letters A to Z and of all beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A language keeps a term from so many of its documents on.
DOCUMENTS = 10
#: Ranks of terms that are returned.
TOP = 10
#: Up to so many groups of language and source (some 50 MB) are broadcast; beyond, both sides are dealt by language and a salt.
GROUPS = 500_000
SALTS = 256


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it); a null text, lang or source is empty."""
    text = F.translate(text_or_empty(), UPPER, LOWER)
    terms = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("terms"))
    # all occurrences, then each distinct term once more: one pass gives both counts
    each = terms.select("lang", "source", F.size("terms").alias("k"), F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("pos", "term"))
    occurs = F.col("pos") < F.col("k")
    return each.groupBy("lang", "source", "term").agg(F.sum(F.when(occurs, 1).otherwise(0)).alias("n"), F.sum(F.when(occurs, 0).otherwise(1)).alias("docs"))


def vocabulary(counts: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, term, lang_n: the terms that stand in at least ``documents`` rows of a language."""
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= documents).drop("docs")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), exactly."""
    wide = "decimal(38,0)"
    top, bottom = (n + 2).cast(wide) * F.lit(1_000_000_000).cast("decimal(10,0)"), (total + 2 * kept).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top.cast(wide), bottom)


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _across(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Each kept term of a language beside each of the language's groups."""
    if groups.count() <= GROUPS:
        return kept.join(F.broadcast(groups), "lang")
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    return salted.join(groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["lang", "salt"]).drop("salt")


def shares(docs: DataFrame, documents: int = DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """The groups (lang, source) of ``docs``, and for each of them every kept term of its language: lang, term, source, n, p, q (the language's)."""
    counts = written(term_counts(docs), "counts")
    kept = written(vocabulary(counts, documents), "vocabulary")
    groups = written(docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct(), "groups")
    known = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "known")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = groups.join(known.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
    wide = _across(kept, written(totals, "totals")).join(known, ["lang", "source", "term"], "left")
    n, total = F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0))
    dense = wide.select("lang", "term", "source", n.alias("n"), _share(n, total, F.col("v")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    return groups, written(dense, "shares")


def source_divergence(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """What sets the sources of each language apart, and what each source has more of than its language.

    Terms are runs of ASCII letters and of code points beyond ASCII, with A to Z
    lower-cased; a language keeps those in at least ``documents`` of its rows. A
    null text, lang or source is empty. Every occurring (lang, source), even one
    without terms, gives each kept term the share p; all arithmetic is exact.
    Repeated rows count each time; other columns are not read; an empty table
    gives an empty result, and a source that is alone in its language has no pairs.

    Returns lang, source, part, item, value, rank: for ``pair`` each other source of the
    language and the divergence, summed over all kept terms (0 if there are none);
    for ``term`` the ``top`` terms of which the source has more than the language.
    """
    groups, dense = shares(docs, documents)
    one, other = (dense.select("lang", "term", F.col("source").alias(s), F.col("p").alias(f"p_{s}")) for s in ("source", "item"))
    half = one.join(other, ["lang", "term"]).filter(F.col("source") < F.col("item"))
    summed = half.groupBy("lang", "source", "item").agg(F.sum(_apart(F.col("p_source"), F.col("p_item"))).alias("value"))
    both = written(summed, "pairs")
    both = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = groups.join(groups.withColumnRenamed("source", "item"), "lang").filter(F.col("source") != F.col("item"))
    pairs = pairs.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    own = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(own))
    more = dense.filter((F.col("n") > 0) & (F.col("p") > F.col("q"))).select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    first = more.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= top)

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(ranked, "pair").unionByName(part(first, "term"))
