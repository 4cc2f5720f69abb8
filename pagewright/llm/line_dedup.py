"""Removal of repeated passages by overlapping windows of three lines.

Each run of three lines is hashed; of a window that occurs more than once
anywhere, the first occurrence stays, and the lines that later ones cover are
merged into spans and removed. All of this is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import written

LINES = 3


#: 128 bits that tell (doc_id, text) apart.
KEY = ["_k1", "_k2"]


def _key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_k1": F.xxhash64("doc_id", "text"), "_k2": F.xxhash64(F.lit("second"), "text", "doc_id")})


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Each window of ``lines`` lines that holds a word: doc_id, KEY, position of its first line, two hashes."""
    held = [f"l[i + {k}]" for k in range(lines)]
    each = f"""transform(sequence(0, size(l) - {lines}), i -> struct(
        i AS pos, xxhash64({", ".join(held)}) AS h1, xxhash64('second', {", ".join(reversed(held))}) AS h2, trim(concat({", ".join(held)})) <> '' AS words))"""
    split = _key(docs).filter(F.col("text").contains("\n")).select("doc_id", *KEY, F.split("text", "\n", -1).alias("l"))
    return split.filter(F.size("l") >= lines).select("doc_id", *KEY, F.expr(f"inline({each})")).filter("words").drop("words")


def removed_spans(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Merged spans of lines that later occurrences cover: KEY, spans (array of first and last line)."""
    found = written(windows(docs, lines), "windows")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos", *KEY)
    repeated = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(at).alias("first")).filter("n > 1").drop("n")
    later = found.join(repeated, ["h1", "h2"]).filter(at != F.col("first")).select(*KEY, "pos").distinct()
    own = W.partitionBy(*KEY).orderBy("pos")
    opens = F.coalesce(F.col("pos") > F.lag("pos").over(own) + lines, F.lit(True)).cast("int")
    runs = later.withColumn("opens", opens).withColumn("run", F.sum("opens").over(own))
    merged = runs.groupBy(*KEY, "run").agg(F.min("pos").alias("start"), (F.max("pos") + lines - 1).alias("end"))
    return merged.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


def drop_repeated_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` without passages that occur earlier: by doc_id (null last), then line.

    A passage is at least ``lines`` consecutive lines that are equal in all
    characters; texts with fewer lines have none, and neither has a run of blank
    lines. A null text stays null. Of rows that agree in doc_id and text the first
    keeps its lines as above and the others lose every window of theirs. A text
    that is covered wholly becomes empty. Other columns are not read.

    Returns doc_id, text (what is left), n_lines, n_removed, removed (spans of
    line numbers from 0, as first-last).
    """
    spans = removed_spans(docs, lines)
    keyed = _key(docs.select("doc_id", "text"))
    # the join and the window deal rows out by the same key, so texts are moved once
    again = F.row_number().over(W.partitionBy(*KEY).orderBy("doc_id")) > 1
    split = keyed.join(spans, KEY, "left").withColumn("again", again).withColumn("l", F.split("text", "\n", -1))
    n = F.size("l")
    whole = F.col("again") & (n >= lines) & F.col("text").rlike(r"\S")
    cut = F.when(whole, F.array(F.struct(F.lit(0).alias("start"), (n - 1).alias("end")))).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")))
    gone = split.withColumn("cut", cut).withColumn("gone", F.flatten(F.transform("cut", lambda s: F.sequence(s["start"], s["end"]))))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone")), lambda i: F.col("l")[i])
    text = F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    return gone.select(
        "doc_id",
        text.alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("l")).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        _listed(F.col("cut")).alias("removed"),
    )
