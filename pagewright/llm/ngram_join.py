"""Jaccard similarity join of documents on word shingles, and its groups.

Documents with equal sets of shingles are one node. A node's shingles are in one
global order, that of their hashes, and nodes can only be similar if they share
shingles near its start. How long a node's prefix is, and how many shingles of it
a partner must share before the two are compared, follows from what its
candidates would cost: a prefix that is longer by l - 1 shingles asks for l.

Links within a group that is already known tell nothing new. So each node is
first held against a few nodes that stand for those it shares most with, and
from then on only candidates of different groups are looked for. Nodes that
share most of their shingles with many others, and yet are similar to few, are
compared by what they differ in from a set that stands for all of them.

The bounds, with p for percent and |A| >= |B| or not as it comes:

- Similar sets share o >= needed(|A|), needed(|B|) shingles. What lies beyond the
  first |A| - needed(|A|) + 1 + s of A is fewer than o - s, so these hold the first
  1 + s of the o in the global order. If A's prefix is s longer, and B's t, both
  hold the first 1 + min(s, t), and so any choice that leaves out d of A's prefix
  holds 1 + min(s, t) - d of B's. d is at most what the smallest partner is longer by.
- A and B are similar where, and only where, |A ^ B| (100 + p) <= (|A| + |B|) (100 - p),
  with ^ for the symmetric difference.
- For any set P, A ^ B = (A ^ P) ^ (B ^ P). With e for |A ^ P| and
  rho(A) = e (100 + p) - |A| (100 - p), A and B are similar where A ^ P and B ^ P share
  at least (rho(A) + rho(B)) / (2 (100 + p)) shingles. If that is not over 0, they are
  similar whatever they share, and both are similar to the set of the least rho.
- |B ^ P| <= |A ^ P| + |A ^ B|, so B is only similar to A if
  rho(B) <= |A ^ P| (100 + p) + |A| (100 - p).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, unused, worker_cache, written

#: Hashes of so many words are kept by a Python worker.
KEPT = 150_000
#: Part of a node's shingles by which its prefix is lengthened, so that as many of the commonest need no lookup.
SLACK = 1 / 8
#: Candidates a node may look up by its prefix; with more, its whole set is taken.
COST = 200
#: Shared shingles that may be asked for, and what a candidate costs more than a row that two shared shingles make.
LEVELS = (1, 2, 4, 8)
COMPARE = 20
#: Rows of a few longs up to which a side of a join is broadcast (about 32 bytes each).
BROADCAST = 500_000
#: Nodes of one shingle that a task joins at most; the other side of the join is repeated for each so many.
HOT = 2000
#: Rounds in which nodes go whose own tokens, in whole sets, leave no room for a partner; others' tokens then become own.
PRUNES = 3
#: Nodes of a token for one pivot, and pivots a token at most.
PART, PARTS = 8, 8
#: Nodes from which on a set stands for them.
MEMBERS = 16

#: Columns of the parities: two sets differ in at least as many shingles as in parities.
PARITY = ("s0", "s1", "s2", "s3")


def _word_hashes(words: list[bytes]) -> np.ndarray:
    kept = worker_cache("shingles")
    try:
        return np.array([kept[w] for w in words], dtype=np.uint64)
    except KeyError:
        if len(kept) > KEPT:
            kept.clear()
        for w in words:
            if w not in kept:
                kept[w] = xxhash.xxh64_intdigest(w)
        return np.array([kept[w] for w in words], dtype=np.uint64)


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``words`` words, A to Z in lower case; of fewer words, the whole as one; of none, nothing."""
    found = text.encode().lower().split()  # of bytes: ASCII letters, and white space as in WORD
    if not found:
        return np.zeros(0, dtype=np.uint64)
    own = _word_hashes(found)
    size = min(words, len(own))
    value = np.full(len(own) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + own[k : k + len(value)]
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(value ^ (value >> np.uint64(31)))


def needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share with any similar set."""
    return -(-n * percent // 100)


def _prefix(n: Column, percent: int) -> Column:
    """Length of the prefix in which one shingle must be shared."""
    return n - F.floor((n * percent + 99) / 100) + 1


def _slack(n: Column, percent: int, part: float) -> Column:
    """Shingles by which a prefix is lengthened, and more of which must be shared."""
    return F.least(n - _prefix(n, percent), F.floor(n * part))


def _scan(words: int, percent: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, high, low, prefixes, parities = [], [], [], [], []
                for text in part.column("text"):
                    own = shingles(text.as_py(), words)
                    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    n = len(own)
                    sizes.append(n)
                    parities.append(np.packbits(np.bincount(own & np.uint64(255), minlength=256).astype(np.uint8) & 1).view("<i8"))
                    high.append(int.from_bytes(digest[:8], "big", signed=True))
                    low.append(int.from_bytes(digest[8:], "big", signed=True))
                    prefixes.append((own if whole else own[: n - needed(n, percent) + 1 + int(n * SLACK)]).view(np.int64))
                kept = [name for name in part.schema.names if name != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in kept), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), *(pa.array([x[k] for x in parities], pa.int64()) for k in range(4))],
                    names=[*kept, "high", "low", "n", "tokens", *PARITY],
                )

    return run


def scanned(docs: DataFrame, words: int, percent: int, whole: bool = False, keep: tuple[str, ...] = ("doc_id", "mark")) -> DataFrame:
    """Of each row ``keep``, a 128-bit digest of the set, its size, its prefix (or the whole set), and for 256 parts of all hashes whether the set has an odd number of them."""
    own = {"mark": _mark()}
    rows = docs.select(*(own.get(c, F.col(c)).alias(c) for c in keep), text_or_empty().alias("text"))
    kinds = "".join(f"{name} {rows.schema[name].dataType.simpleString()}, " for name in keep)
    return rows.mapInArrow(_scan(words, percent, whole), f"{kinds}high long, low long, n long, tokens array<long>, {', '.join(f'{c} long' for c in PARITY)}")


def _mark() -> Column:
    """A hash of a row's doc_id and text."""
    return F.xxhash64("doc_id", "text")


def _small(df: DataFrame) -> DataFrame:
    """``df``, a written table of a few long columns, for broadcast if it has at most BROADCAST rows; else the join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def _overlaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            left, right = batch.column("ta"), batch.column("tb")
            for i in range(batch.num_rows):
                a, b = left[i].values.to_numpy(), right[i].values.to_numpy()
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    keep.append(i)
            taken = batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
            yield taken

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose whole sets are similar."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b").select("a", "b", "ta", "tb")
    return two.mapInArrow(_overlaps(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and group (its smallest node) of all nodes of the written ``links`` (a, b), by label steps with shortcuts."""
    both = written(links.filter("a <> b").select("a", "b").union(links.filter("a <> b").select("b", "a")).toDF("node", "near").distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("group")), "groups")
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), F.col("group").alias("g")), "near").groupBy("node").agg(F.min("g").alias("g"))
        lower = labels.join(near, "node").select("node", "group", F.least("group", "g").alias("down"))
        jump = labels.select(F.col("node").alias("down"), F.col("group").alias("far"))
        moved = written(lower.join(jump, "down", "left").select("node", "group", F.least("down", F.coalesce("far", "down")).alias("next")), "groups")
        labels = moved.select("node", F.col("next").alias("group"))
        if moved.filter("group <> next").isEmpty():
            return labels


def _grouped(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """``nodes`` with the group of each, itself where it has no link yet."""
    return nodes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _near_in_size(percent: int) -> Column:
    return (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)


def _shared(postings: DataFrame) -> DataFrame:
    """Postings (node, n, group, token) whose token is in several groups, with how many postings it has."""
    tokens = postings.groupBy("token").agg(F.count("*").alias("df"), F.min("group").alias("g0"), F.max("group").alias("g1")).filter("g0 <> g1").select("token", "df")
    return postings.join(tokens, "token")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _against_pivots(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of each node and the pivots with which it shares half of its prefix.

    A token's nodes fall into parts, one for each PART nodes and PARTS at most, and
    the most central node of a part, whose tokens most others have, is a pivot. A text
    that many copies come from is nearer to them than they are to each other. The
    nodes of a frequent token meet its pivots in salted parts.
    """
    node = W.partitionBy("node")
    parts, salts = F.least(F.lit(PARTS), F.ceil(F.col("df") / PART)), F.ceil(F.col("df") / HOT)
    length = _prefix(F.col("n"), percent) + _slack(F.col("n"), percent, SLACK)
    ranked = postings.withColumns({"rank": F.sum("df").over(node) / length, "part": F.pmod(F.xxhash64("node", F.lit("part")), parts)})
    pivots = ranked.groupBy("token", "part").agg(F.max(F.struct("rank", "node", "n")).alias("p"), F.first("df").alias("df"))
    sent = pivots.select("token", "p", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    met = postings.withColumn("salt", F.pmod(F.xxhash64("node"), salts)).join(sent, ["token", "salt"])
    met = met.select("node", "n", F.col("p.node").alias("pivot"), F.col("p.n").alias("m"))
    counts = met.filter((F.col("node") != F.col("pivot")) & _near_in_size(percent)).groupBy("node", "n", "pivot").agg(F.count("*").alias("c"))
    return counts.filter(F.col("c") * 2 >= length).select(*_ordered("node", "pivot")).distinct()


def _placed(shared: DataFrame, percent: int) -> DataFrame:
    """``shared`` postings of prefixes with ``own``, the tokens of the prefix that no other group has, and ``k``, the place by falling frequency."""
    node = W.partitionBy("node")
    length = _prefix(F.col("n"), percent) + _slack(F.col("n"), percent, SLACK)
    return shared.withColumns({"own": length - F.count("*").over(node), "k": F.row_number().over(node.orderBy(F.desc("df"), "token"))})


def _left_out(percent: int) -> Column:
    """Shingles by which the prefix of a node's smallest possible partner is lengthened: so many of the node's own need no lookup."""
    least = F.floor((F.col("n") * percent + 99) / 100)
    return F.least(F.floor((least * percent + 99) / 100) - 1, F.floor(least * SLACK))


def _levelled(placed: DataFrame, percent: int) -> DataFrame:
    """For each node how many shared tokens to ask for (``level``), and the ``cost`` of what it then looks up.

    One more that is asked for brings one more of the commoner tokens in, and as
    many fewer candidates to be compared.
    """
    out = _left_out(percent)
    costs = placed.groupBy("node").agg(F.first(out).alias("out"), *(F.coalesce(F.sum(F.when(F.col("k") > out + 1 - level, F.col("df"))), F.lit(0)).alias(f"c{level}") for level in LEVELS))
    options = F.array(*(F.when(F.col("out") + 1 >= level, F.struct((F.col(f"c{level}") * (1 + COMPARE / level)).alias("price"), F.lit(level).alias("level"), F.col(f"c{level}").alias("cost"))) for level in LEVELS))
    best = F.array_min(F.filter(options, lambda o: o.isNotNull()))
    return costs.select("node", best["level"].alias("level"), best["cost"].alias("cost"))


def _meeting(lookups: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different groups that share as many of the lookups as their node's ``level``, and whose sizes, own tokens and parities leave room for the overlap that they need.

    Own tokens are in no partner only where the partner's prefix ends no earlier:
    else it may hold them beyond its prefix.
    """
    index = placed.filter(F.col("df") <= COST).select("token", F.col("node").alias("b"), F.col("n").alias("m"), F.col("group").alias("other"), F.col("own").alias("own_b"), F.col("end").alias("end_b"), *(F.col(c).alias(f"{c}_b") for c in PARITY))
    need = (F.col("n") + F.col("m")) * percent
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in PARITY), F.lit(0))
    like = (F.col("n") + F.col("m") - apart) * (100 + percent) >= need * 2
    room = lambda n, own: (F.col(n) - F.col(own)) * (100 + percent) >= need
    fits = ((F.col("end") > F.col("end_b")) | room("n", "own")) & ((F.col("end_b") > F.col("end")) | room("m", "own_b"))
    met = lookups.join(index, "token").filter((F.col("group") != F.col("other")) & _near_in_size(percent) & fits & like)
    return met.groupBy("node", "b", "level").agg(F.count("*").alias("c")).filter("c >= level").select(*_ordered("node", "b")).distinct()


def _pruned(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of whole sets that other groups have, too, with df, without the nodes whose shared tokens are too few for any partner."""
    shared = _shared(postings)
    for _ in range(PRUNES):
        shared = written(shared, "shared")
        able = shared.groupBy("node").agg(F.count("*").alias("c"), F.first("n").alias("n")).filter(F.col("c") * 100 >= F.col("n") * percent).select("node")
        shared = _shared(shared.join(able, "node", "left_semi").drop("df"))
    return written(shared, "shared")


def _hubs(postings: DataFrame) -> DataFrame:
    """hub, token: sets that stand for MEMBERS nodes or more each, written.

    Each node goes to the central node that is the most central one for most of its
    tokens, and the tokens that half of those nodes have are the set.
    """
    rank = postings.groupBy("node").agg((F.sum("df") / F.first("n")).alias("rank"))
    top = postings.join(rank, "node").groupBy("token").agg(F.max(F.struct("rank", "node")).alias("t")).select("token", F.col("t.node").alias("hub"))
    votes = postings.select("node", "token").join(top, "token").groupBy("node", "hub").agg(F.count("*").alias("c"))
    home = written(votes.groupBy("node").agg(F.max(F.struct("c", "hub")).alias("h")).select("node", "h.hub"), "homes")
    large = home.groupBy("hub").agg(F.count("*").alias("members")).filter(F.col("members") >= MEMBERS)
    held = postings.select("node", "token").join(home.join(large, "hub"), "node").groupBy("hub", "token").agg(F.count("*").alias("c"), F.first("members").alias("members"))
    return written(held.filter(F.col("c") * 2 >= F.col("members")).select("hub", "token"), "hubs")


def _rho(size: Column, percent: int) -> Column:
    return size * (100 + percent) - F.col("n") * (100 - percent)


def _guests(postings: DataFrame, hubs: DataFrame, nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of each hub, and those that are near none.

    ``nodes`` has node, n, group. A node is near a hub from which it differs in at
    most half as many tokens as it has. With it the hub has all nodes that may be
    similar to it. Gives hub, node, n, group, size (of the difference), rho; and node.
    """
    sizes = hubs.groupBy("hub").agg(F.count("*").alias("m"))
    both = postings.select("node", "token").join(_small(hubs), "token").groupBy("node", "hub").agg(F.count("*").alias("c"))
    size = F.col("n") + F.col("m") - 2 * F.col("c")
    held = both.join(sizes, "hub").join(nodes, "node").select("hub", "node", "n", "group", size.alias("size"), _rho(size, percent).alias("rho"))
    held = written(held, "near-hubs")
    best = held.groupBy("node").agg(F.min(F.struct("size", "hub", "n")).alias("h")).select("node", "h.*")
    member = best.filter((F.col("size") * 2 <= F.col("n")) & (F.col("size") * 100 < F.col("n") * percent))
    reach = member.groupBy("hub").agg(F.max(F.col("size") * (100 + percent) + F.col("n") * (100 - percent)).alias("reach"))
    guests = held.join(reach, "hub").filter(F.col("rho") <= F.col("reach")).drop("reach")
    return written(guests, "guests"), written(nodes.join(member, "node", "left_anti").select("node"), "far")


def _by_difference(deltas: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of ``deltas``: hub, node, n, group, size, rho, open, least (of all open rho of the hub), token.

    Wanted are pairs of different groups of which one is open. Of two, that of the
    smaller rho looks the other up, which shares at least ``need`` tokens of its
    difference. Leaving out need - level of the commonest of these, it shares level.
    """
    need = F.ceil((F.col("rho") + F.greatest("rho", "least")) / F.lit(2 * (100 + percent))).cast("long")
    tokens = deltas.groupBy("hub", "token").agg(F.count("*").alias("df"), F.count_if("open").alias("df_open"), F.min("group").alias("g0"), F.max("group").alias("g1"))
    tokens = tokens.filter("g0 <> g1 AND df_open > 0").select("hub", "token", F.col("df").alias("all"), "df_open")
    held = written(deltas.withColumn("need", F.greatest(need, F.lit(1))).join(tokens, ["hub", "token"]).withColumn("df", F.when(F.col("open"), F.col("all")).otherwise(F.col("df_open"))), "differences")
    node = W.partitionBy("hub", "node")
    ranked = held.withColumns({"k": F.row_number().over(node.orderBy(F.desc("df"), "token")), "has": F.count("*").over(node)}).filter("has >= need")
    cost = {level: F.sum(F.when(F.col("k") > F.col("need") - level, F.col("df")).otherwise(0)).over(node) for level in LEVELS}
    level = F.lit(1)
    for higher in LEVELS[1:]:  # as many as cost twice as many rows at most
        level = F.when((F.col("need") >= higher) & (cost[higher] <= 2 * cost[1] + 64), F.lit(higher)).otherwise(level)
    lookups = ranked.withColumn("level", level).filter(F.col("k") > F.col("need") - F.col("level"))
    salts = F.ceil(F.col("all") / HOT)
    lookups = lookups.select("hub", "token", "open", "node", "n", "group", "rho", "need", "level", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    # what is not open meets only what is
    index = held.select("hub", "token", F.explode(F.when(F.col("open"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("open"), F.pmod(F.xxhash64("node"), salts).alias("salt"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("group").alias("other"), F.col("rho").alias("rho_b"))
    later = (F.col("rho_b") > F.col("rho")) | ((F.col("rho_b") == F.col("rho")) & (F.col("b") > F.col("node")))
    met = lookups.join(index, ["hub", "token", "open", "salt"]).filter((F.col("group") != F.col("other")) & later & _near_in_size(percent))
    pairs = met.groupBy("hub", "node", "b").agg(F.count("*").alias("c"), *(F.first(x).alias(x) for x in ("rho", "rho_b", "need", "level")))
    # a partner of a larger rho must share as many more
    exact = F.ceil((F.col("rho") + F.col("rho_b")) / F.lit(2 * (100 + percent)))
    return pairs.filter(F.col("c") >= F.greatest("level", F.col("level") + exact - F.col("need"))).select(*_ordered("node", "b")).distinct()


def _among_dear(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) among the nodes of the ``sets`` (node, n, tokens)."""
    known = _grouped(sets.select("node", "n"), groups)
    postings = _pruned(_grouped(sets.select("node", "n", F.explode("tokens").alias("token")), groups), percent)
    able = written(known.join(postings.select("node").distinct(), "node", "left_semi").select("node", "n", "group"), "able")
    hubs = _hubs(postings)
    guests, far = _guests(postings, hubs, able, percent)
    # each hub's group at the least rho, and what is similar to it as it differs so little
    centre = guests.groupBy("hub").agg(F.min(F.struct("rho", "node", "group")).alias("c"))
    joined = guests.join(centre, "hub").withColumn("inner", F.col("rho") + F.col("c.rho") <= 0)
    star = written(joined.filter(F.col("inner") & (F.col("group") != F.col("c.group"))).select(*_ordered("node", "c.node")), "candidates")
    group = F.when(F.col("inner"), F.col("c.group")).otherwise(F.col("group"))
    marked = joined.withColumn("group", group).withColumn("open", F.col("group") != F.col("c.group")).drop("c", "inner")
    least = marked.filter("open").groupBy("hub").agg(F.min("rho").alias("least"))
    marked = written(marked.join(least, "hub"), "guests")
    whole = hubs.join(least.select("hub"), "hub", "left_semi").groupBy("hub").agg(F.collect_list("token").alias("held"))
    apart = F.concat(F.array_except("tokens", "held"), F.array_except("held", "tokens"))
    near = marked.join(sets.select("node", "tokens"), "node").join(whole, "hub").select(*marked.columns, F.explode(apart).alias("token"))
    pairs = [star, written(_by_difference(near, percent), "candidates")]
    if not far.isEmpty():
        # the hub of any other node has all that may be similar to it; from nothing, a set differs in all its tokens
        bare = postings.join(_small(far), "node").select(
            F.lit(-1).cast("long").alias("hub"), "node", "n", "group", F.col("n").alias("size"), _rho(F.col("n"), percent).alias("rho"), F.lit(True).alias("open"), F.lit(0).cast("long").alias("least"), "token"
        )
        pairs.append(written(_by_difference(bare, percent), "candidates"))
    out = pairs[0]
    for more in pairs[1:]:
        out = out.unionByName(more)
    return out


class _Sets:
    """Whole sets of chosen nodes, made from their texts when they are first wanted."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> None:
        self.docs, self.classes, self.words, self.percent = docs, classes, words, percent
        self.made: DataFrame | None = None

    def of(self, nodes: DataFrame) -> DataFrame:
        """node, n, tokens; ``nodes`` has a column node."""
        wanted = nodes.select("node").distinct()
        fresh = wanted if self.made is None else wanted.join(self.made.select("node"), "node", "left_anti")
        chosen = written(self.classes.join(fresh, "node", "left_semi").select("node", "mark", F.col("high").alias("h"), F.col("low").alias("l")), "chosen")
        texts = self.docs.select(_mark().alias("mark"), "text").join(_small(chosen), "mark")
        sets = scanned(texts.select("node", "h", "l", "text"), self.words, self.percent, whole=True, keep=("node", "h", "l")).filter("h = high AND l = low")
        sets = written(sets.select("node", "n", "tokens"), "sets")
        if sets.count() > chosen.count():  # repeated rows
            sets = written(sets.dropDuplicates(["node"]), "sets")
        self.made = sets if self.made is None else self.made.unionByName(sets)
        return self.made.join(_small(written(wanted, "wanted")), "node", "left_semi")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the written, distinct ``pairs`` whose sets are similar, written."""
        sets = self.of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        return written(verified(pairs, sets, self.percent), "verified")


def _between_groups(shared: DataFrame, groups: DataFrame, sets: _Sets, marks: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different groups: every similar pair of those is among them, or linked through other ones that are.

    ``marks`` has the parities and the prefix's end of each node. Nodes whose
    lookups would bring over COST candidates meet the others through these, and
    each other through their whole sets.
    """
    placed = written(_placed(_shared(_grouped(shared.select("node", "n", "token"), groups)), percent).join(marks, "node"), "placed")
    levels = written(_levelled(placed, percent), "levels")
    chosen = placed.join(levels.filter(F.col("cost") <= COST), "node").filter(F.col("k") > _left_out(percent) + 1 - F.col("level"))
    pairs = written(_meeting(chosen, placed, percent), "candidates")
    dear = levels.filter(F.col("cost") > COST).select("node")
    if dear.isEmpty():
        return pairs
    more = _among_dear(sets.of(dear), groups, percent)
    return written(pairs.unionByName(more).distinct(), "candidates")


class Join:
    """One run of the join; ``candidates`` has the tables of pairs that it compared."""

    def __init__(self, docs: DataFrame, words: int, percent: int) -> None:
        self.percent, self.candidates = percent, []
        self.rows = written(scanned(docs, words, percent).withColumn("row", F.monotonically_increasing_id()), "prefixes")
        self.filled = self.rows.filter("n > 0")
        first = F.min_by(F.struct("mark", "n"), "row").alias("first")
        classes = self.filled.groupBy("high", "low").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("rows"), first)
        self.classes = written(classes.select("high", "low", "node", "least", "rows", "first.*"), "classes")
        self.sets = _Sets(docs, self.classes, words, percent)

    def _compared(self, pairs: DataFrame) -> DataFrame:
        self.candidates.append(pairs)
        return self.sets.verified(pairs)

    def groups(self) -> DataFrame:
        """node and group of all nodes with a link."""
        copies = self.classes.filter("rows > 1").select("high", "low", F.col("node").alias("kept"))
        extra = written(self.filled.select("row", "high", "low").join(copies, ["high", "low"]).filter("row <> kept").select("row"), "copies")
        nodes = self.filled.select("row", "n", "tokens").join(_small(extra), "row", "left_anti")
        postings = nodes.select(F.col("row").alias("node"), "n", F.explode("tokens").alias("token"))
        often = postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
        shared = written(postings.join(often, "token"), "postings")
        end = F.element_at("tokens", -1).bitwiseXOR(F.lit(-(1 << 63)))  # signed as tokens are ordered
        marks = self.filled.select(F.col("row").alias("node"), *PARITY, end.alias("end"))

        links = self._compared(written(_against_pivots(shared, self.percent), "pivots"))
        groups = components(links)
        found = self._compared(_between_groups(shared, groups, self.sets, marks, self.percent))
        return groups if found.isEmpty() else components(links.unionByName(found))

    def rows_by_group(self) -> DataFrame:
        """doc_id, mark, n_shingles, group, component_id, node of each row; group and node are null for empty sets."""
        known = written(_grouped(self.classes.select("high", "low", "node", "least"), self.groups()), "known")
        smallest = known.groupBy("group").agg(F.min("least").alias("component_id"))
        named = known.join(smallest, "group").select("high", "low", "node", "group", "component_id")
        none = F.lit(None).cast("long")
        empty = self.rows.filter("n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), none.alias("group"), F.col("doc_id").alias("component_id"), none.alias("node"))
        full = self.filled.select("doc_id", "mark", "n", "high", "low").join(named, ["high", "low"])
        return full.select("doc_id", "mark", F.col("n").alias("n_shingles"), "group", "component_id", "node").unionByName(empty)


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The group of each row of ``docs`` under links of similar shingle sets.

    Words are separated by ``[\\x20\\x09-\\x0D]``, with A to Z in lower case. Sets are
    similar when 100 * intersection >= percent * union. A text without words, or
    null, has an empty set and no link. Rows count each, also with equal or null
    doc_id; equal sets are always one group. A group's id is its smallest doc_id.
    Other columns are not read; an empty table gives an empty result.

    Returns doc_id, n_shingles, component_id, node (equal sets share one; null
    for empty sets).
    """
    return Join(docs, words, percent).rows_by_group().select("doc_id", "n_shingles", "component_id", "node")


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest doc_id (null last).

    Rows without words all stay. Of rows that agree in doc_id and text, but
    differ in other columns, one stays.
    """
    found = written(Join(docs, words, percent).rows_by_group().filter("n_shingles > 0").select("doc_id", "mark", "group"), "found")
    stays = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("s"), F.count("*").alias("rows"))
    marked = found.join(stays.filter("rows > 1"), "group").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("mark") == F.col("s.mark")))
    marked = written(marked.select("doc_id", "mark", "stays").groupBy("doc_id", "mark").agg(F.max("stays").alias("stays"), F.count("*").alias("rows")), "marked")
    mark, doc_id = unused(docs, "mark", "id")
    keyed = docs.withColumn(mark, _mark())

    def rows(of: DataFrame, how: str) -> DataFrame:
        other = of.select(F.col("doc_id").alias(doc_id), F.col("mark").alias(f"{mark}_"))
        return keyed.join(other, keyed["doc_id"].eqNullSafe(other[doc_id]) & (keyed[mark] == other[f"{mark}_"]), how).select(*keyed.columns)

    kept = rows(marked.filter("NOT stays OR rows > 1"), "left_anti")
    repeated = marked.filter("stays AND rows > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows(repeated, "left_semi").dropDuplicates(["doc_id", mark]))
    return kept.select(*docs.columns)
