"""Mixing sources to target weights by entropy balancing.

Each document gets a rate: the least change from one copy, in relative entropy,
that makes every source's expected words equal its target, with no rate over a
cap. The solution tilts rates exponentially in the document's size, with one
multiplier a source, the root of a convex dual that Newton steps find over the
counts of equal sizes. Rates are then rounded into whole copies by systematic
sampling: along a source's documents by size, the parts of copies add up, and
each whole one that the sum passes is a copy more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import WORD, text_or_empty, unused, written

#: Most copies of a document, and most times its own size that a source may give.
CAP = 3
#: Equally long documents of a source fall into a part for each so many rows of the table, within the limits, so that no task ranks them all.
SALTED = 200_000
SALTS = (64, 1 << 16)
#: Newton steps at most, and the part of the target that may be missed before rounding.
STEPS = 60
CLOSE = 1e-8
#: Starts of the systematic sample that are tried; the one with the source nearest its target is taken.
STARTS = 64
#: Documents a source that then get or lose a copy at most, to bring it nearer still.
REPAIRS = 4


def _salts(docs: DataFrame) -> int:
    return min(SALTS[1], max(SALTS[0], docs.count() // SALTED))


def _marks(salts: int, names: tuple[str, ...] = ("key", "size", "lot", "salt")) -> dict[str, Column]:
    """What the mix reads of a document: the source (told apart from null), size in words, and by hashes of doc_id and text a lot and a salt."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    lot = F.xxhash64("doc_id", "text")
    return dict(zip(names, (key, size, lot, F.pmod(lot, F.lit(salts)).cast("int")), strict=True))


def cycling_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` (key, source_size) with weights that repeat over the sources by code point, null last; a row a source."""
    order = F.row_number().over(W.orderBy(F.col("key") == "", "key")) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")).cast("double"))


def targets(weighted: DataFrame, words: Column | None = None, cap: float = CAP) -> DataFrame:
    """Targets in proportion to weight, none over ``cap`` times its source; what is over goes to the others by weight.

    Resharing ends at one level of words a unit of weight. With the sources in the
    order of cap / weight, the level that is left after the first k are capped is
    largest just where no more are. Works on a row a source.
    """
    total = F.sum("source_size").over(W.partitionBy())
    limit = F.col("source_size") * cap
    order = W.orderBy(limit / F.col("weight"), "key")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    capped = weighted.filter("weight > 0").withColumns({"words": words if words is not None else total, "limit": limit})
    rest = F.col("words") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    level = F.max("level").over(W.partitionBy())
    given = capped.withColumn("level", rest / weight).withColumn("target", F.least("limit", F.col("weight") * F.greatest(level, F.lit(0.0))))
    return weighted.join(given.select("key", "target"), "key", "left").fillna(0.0, ["target"])


def _rate(cap: float) -> Column:
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("scale"), F.lit(50.0)))))


def _exact_sum(c: Column) -> Column:
    """A sum that does not depend on the order of its rows."""
    return F.sum(c.cast("decimal(28,8)")).cast("double")


def multipliers(cells: DataFrame, aims: DataFrame, cap: float = CAP, steps: int = STEPS) -> DataFrame:
    """The dual's root for each source: key, multiplier, scale, full (every rate is the cap).

    ``cells`` has key, size, count; ``aims`` key, source_size, target. Each step is
    one aggregate over the cells. The dual's slope rises with the multiplier, so
    each step also narrows a bracket, which catches steps that leave it.
    """
    mean = cells.groupBy("key").agg((F.sum(F.col("size") * F.col("count")) / F.greatest(F.sum("count"), F.lit(1))).alias("scale"))
    state = aims.join(mean, "key").select(
        "key",
        "target",
        F.greatest("scale", F.lit(1e-9)).alias("scale"),
        (F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("multiplier"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        ((F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)) | (F.col("source_size") == 0)).alias("done"),
    )
    state = written(state, "multipliers")
    for _ in range(steps):
        tilt = F.col("size") / F.col("scale")
        words = F.col("count") * F.col("size") * F.col("rate")
        slope = F.when(F.col("rate") < cap, words * tilt).otherwise(0.0)
        open_ = state.filter("not done")
        sums = cells.join(open_.select("key", "multiplier", "scale", "full"), "key").withColumn("rate", _rate(cap)).groupBy("key").agg(_exact_sum(words).alias("words"), _exact_sum(slope).alias("slope"))
        miss = F.col("words") - F.col("target")
        low = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(miss >= 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - F.greatest(F.least(miss / F.col("slope"), F.lit(4.0)), F.lit(-4.0)))
        inside = (newton > F.coalesce(F.col("low"), F.lit(-1e12))) & (newton < F.coalesce(F.col("high"), F.lit(1e12)))
        middle = F.coalesce((F.col("low") + F.col("high")) / 2, F.when(miss < 0, F.col("multiplier") * 2 + 1).otherwise(F.col("multiplier") * 2 - 1))
        moved = (
            open_.join(sums, "key")
            .withColumns({"low": low, "high": high})
            .withColumn("done", F.abs(miss) <= F.greatest(F.col("target") * CLOSE, F.lit(1e-6)))
            .withColumn("multiplier", F.when(F.col("done"), F.col("multiplier")).when(inside, newton).otherwise(middle))
        )
        state = written(state.filter("done").unionByName(moved.select(*state.columns)), "multipliers")
        if state.filter("not done").isEmpty():
            break
    return state


def rounded(cells: DataFrame) -> DataFrame:
    """``cells`` (key, size, count, rate, target) with ``base`` copies of each document, and ``part`` and ``before``: what a document of the cell, and all those before the cell, have over whole copies.

    Documents up to a place in the order of sizes have as many copies more as the
    sum of parts up to there has passed whole numbers, so any run of sizes is taken
    as its rates say, but for one copy. Of STARTS starts of the sum, all equally
    fair, each source takes the one that comes nearest its target.
    """
    part = F.col("rate") - F.col("base")
    upto = F.sum(F.col("count") * F.col("part")).over(W.partitionBy("key").orderBy("size"))
    summed = cells.withColumn("base", F.floor("rate").cast("long")).withColumn("part", part).withColumn("before", upto - F.col("count") * F.col("part"))
    summed = written(summed, "parts")
    starts = [(k + 0.5) / STARTS for k in range(STARTS)]
    words = lambda u: F.sum(F.col("size") * (F.col("count") * F.col("base") + _more(F.col("count"), F.lit(u))))
    misses = summed.groupBy("key").agg(F.first("target").alias("aim"), *(words(u).alias(f"w{k}") for k, u in enumerate(starts)))
    by_miss = F.array_min(F.array(*(F.struct(F.abs(F.col(f"w{k}") - F.col("aim")).alias("miss"), F.lit(u).alias("start")) for k, u in enumerate(starts))))
    chosen = misses.select("key", by_miss["start"].alias("start"))
    return _repaired(summed.join(chosen, "key"))


def _more(n: Column, start: Column) -> Column:
    """How many of the first ``n`` documents of a cell get one copy more."""
    before = F.col("before") + start
    return (F.floor(before + n * F.col("part") + 1e-9) - F.floor(before + 1e-9)).cast("long")


def _repaired(cells: DataFrame) -> DataFrame:
    """``cells`` with ``extra``, in all how many documents of each get one copy more, after up to REPAIRS documents a source got or lost one.

    The document is that whose size comes nearest to what is missing, and its rate
    not near a whole number as long as there is such a document.
    """
    out = cells.withColumn("extra", _more(F.col("count"), F.col("start")))
    for k in range(REPAIRS):
        out = written(out, "repaired")
        given = out.groupBy("key").agg(F.first("target").alias("aim"), F.sum((F.col("count") * F.col("base") + F.col("extra")) * F.col("size")).alias("given"))
        left = given.select("key", (F.col("aim") - F.col("given")).alias("left"))
        far = F.lit(0.1 if k < REPAIRS - 1 else 1e-9)
        able = F.when(F.col("left") > 0, (F.col("part") >= far) & (F.col("extra") < F.col("count"))).otherwise((F.col("part") > 1e-9) & (F.col("part") <= 1 - far) & (F.col("extra") > 0))
        off = F.abs(F.abs("left") - F.col("size"))
        best = out.join(left, "key").filter(able & (F.col("size") > 0) & (off < F.abs("left"))).groupBy("key").agg(F.min_by(F.struct("size", F.signum("left").alias("sign")), F.struct(off, "size")).alias("best"))
        step = F.when(F.col("best.size") == F.col("size"), F.col("best.sign").cast("long")).otherwise(F.lit(0).cast("long"))
        out = out.join(best, "key", "left").withColumn("extra", F.col("extra") + F.coalesce(step, F.lit(0))).drop("best")
    return out


def _plan(salted: DataFrame, weights: DataFrame | None, words: int | None, cap: int) -> DataFrame:
    """For each key, size and salt of ``salted`` (with n, its documents): source_size, target, rate, base and extra, the documents of the part with one copy more."""
    cells = written(salted.groupBy("key", "size").agg(F.sum("n").alias("count")), "sizes")
    sources = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"))
    if weights is None:
        weighted = cycling_weights(sources)
    else:
        keyed = weights.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"), F.col("weight").cast("double"))
        weighted = sources.join(keyed.groupBy("key").agg(F.sum("weight").alias("weight")), "key", "left").fillna(0.0, ["weight"])
    aims = written(targets(weighted, None if words is None else F.lit(float(words)), cap), "targets")
    tilt = multipliers(cells, aims, cap)
    rated = cells.join(tilt.select("key", "multiplier", "scale", "full"), "key").withColumn("rate", F.when(F.col("size") > 0, _rate(cap)).otherwise(1.0))
    plan = written(rounded(rated.join(aims.select("key", "source_size", "target"), "key").select("key", "size", "count", "rate", "source_size", "target")), "copies")
    # a cell's extra copies are dealt out over its salted parts as they grow
    upto = F.sum("n").over(W.partitionBy("key", "size").orderBy("salt"))
    share = lambda n: F.floor(F.col("all").cast("decimal(19,0)") * n / F.col("count"))
    parts = salted.join(plan.withColumnRenamed("extra", "all"), ["key", "size"]).withColumn("upto", upto)
    return parts.select("key", "size", "salt", "source_size", "target", "rate", "base", (share(F.col("upto")) - share(F.col("upto") - F.col("n"))).cast("long").alias("extra"))


def _dealt(rows: DataFrame, plan: DataFrame, names: tuple[str, ...], copies: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows``, whose marks have the given ``names``, with how many copies each gets by ``plan``, and ``keep`` of it."""
    key, size, lot, salt = names
    rank = F.row_number().over(W.partitionBy(key, size, salt).orderBy(lot, "doc_id"))
    own = rows.columns
    named = plan.select(F.col("key").alias(key), F.col("size").alias(size), F.col("salt").alias(salt), F.struct("base", "extra", *keep).alias(copies))
    out = rows.join(named, [key, size, salt]).withColumn(lot, rank)
    number = F.col(copies)["base"] + (F.col(lot) <= F.col(copies)["extra"]).cast("long")
    return out.select(*(c for c in own if c not in names), *(F.col(c) for c in (size,) if keep), *(F.col(copies)[c].alias(c) for c in keep), number.alias(copies))


def mix(docs: DataFrame, weights: DataFrame | None = None, words: int | None = None, cap: int = CAP) -> DataFrame:
    """How often each row of ``docs`` is taken so that sources reach their targets.

    Size is the number of words (null text: 0). ``weights`` has source and weight
    (a source that it lacks weighs 0); without it weights 1, 2, 3 repeat over the
    sources by code point, null last. Targets share ``words`` (or all sizes) by
    weight, at most ``cap`` times a source. Copies follow the rates, see rounded;
    which of equally long documents get one more is settled by a hash of doc_id and
    text, so reruns agree. Repeated rows count each; other columns are not read; an
    empty table gives an empty result.

    Returns doc_id, source, size, source_size, target, rate, copies, taken.
    """
    marks = _marks(_salts(docs))
    rows = written(docs.select("doc_id", F.col("source").cast("string").alias("source"), *(c.alias(n) for n, c in marks.items())), "sized")
    salted = written(rows.groupBy("key", "size", "salt").agg(F.count("*").alias("n")), "salted-sizes")
    dealt = _dealt(rows, _plan(salted, weights, words, cap), tuple(marks), "copies", ("source_size", "target", "rate"))
    return dealt.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, words: int | None = None, cap: int = CAP) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix`` takes it, with their columns as they were."""
    salts = _salts(docs)
    marks = _marks(salts)
    salted = written(docs.select(*(c.alias(n) for n, c in marks.items())).groupBy("key", "size", "salt").agg(F.count("*").alias("n")), "salted-sizes")
    *names, copies, time = unused(docs, *marks, "copies", "time")
    dealt = _dealt(docs.withColumns(_marks(salts, tuple(names))), _plan(salted, weights, words, cap), tuple(names), copies)
    return dealt.withColumn(time, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))).select(*docs.columns)
