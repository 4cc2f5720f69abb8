import hashlib
import random
import zlib

import pytest

from pagewright.llm import prefix_trie as P
from pagewright.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, idx long, key string, n long, seq string"


def talk(spark, rows):
    """Turns from (conv_id, turn, role, text), with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "k", 2, "s") for r in rows], SCHEMA)


def item(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, item(role, text), role or "", text or ""))
    full = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - c % 5
        full[c] = tuple(t[3:] for t in [*sorted(own.get(base, []))[:h], *sorted(own[c])[h:]])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for path, convs in members.items():
        subtree = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in subtree if p)
        leaves = [p for p in subtree if not any(q[:-1] == p for q in members if q)]
        ends = ",".join(str(c) for c in sorted(convs) if len(full[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), sum(bool(q) and q[:-1] == path for q in members), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, convs, names, longest):
    rnd, rows = random.Random(seed), []
    for c in range(convs):
        for k in range(rnd.randint(1, longest)):
            rows.append((c, k if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", None]) if names > 2 else "user", rnd.choice([f"täxt {'x' * j}" for j in range(names)] + [None])))
    return rows


@pytest.mark.parametrize(("seed", "convs", "names", "longest"), [(1, 60, 1, 12), (2, 90, 2, 9), (3, 80, 5, 10), (4, 40, 1, 30), (5, 1, 3, 20)])
def test_against_brute_force(spark, seed, convs, names, longest):
    rows = made(seed, convs, names, longest)
    assert told(prefix_trie(talk(spark, rows))) == brute(rows)


def test_nodes_over_many_blocks(spark):
    """A first turn that nearly all share, many copies, and blocks of a few conversations each, so that intervals cross several."""
    rows = made(6, 120, 2, 10) + [(c, k, "user", "hot" if k < 8 else f"t{c % 3}" if c % 2 else f"u{c}") for c in range(200, 320) for k in range(9 + c % 4)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        conversations = talk(spark, rows)
        sorted_rows = P.written(P.ordered(P.rebuilt(conversations)), "test-ordered")
        assert sorted_rows.select(P._block()).distinct().count() > 10
        assert told(prefix_trie(conversations)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_repeats_and_long_conversations(spark):
    rows = [(None, 1, "user", "nobody's"), (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (1, 3, "user", ""), (1, 3, "user", ""), (-3, 1, "x", "y"), (7, 1, "user", "z" * 5000)]
    rows += [(8, k, "user", f"turn {k}") for k in range(700)] + [(9, k, "user", f"turn {k}") for k in range(650)]
    assert [r for r in told(prefix_trie(talk(spark, [x for x in rows if (x[0] or 0) >= 0])))] == brute([x for x in rows if (x[0] or 0) >= 0])
    got = told(prefix_trie(talk(spark, rows)))
    assert max(r[1] for r in got) >= 690 and any(r[0] == -3 for r in got)


def test_turnless_alone_and_nothing(spark):
    gone = next(c for c in range(1, 100, 5) if zlib.crc32(str(c).encode()) % 9 > 1)  # its family's first is absent
    assert told(prefix_trie(talk(spark, [(gone, 0, "user", "x")]))) == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]
    assert prefix_trie(talk(spark, [])).count() == 0


def test_ids_of_one_group_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "IDS", 7)
    convs = spark.range(500).selectExpr("id AS conv_id", "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS key")
    got = {r["key"]: r["ends_sha256"] for r in P.id_digests(convs).collect()}
    assert got["hot"] == hashlib.sha256(",".join(str(i) for i in range(0, 500, 3)).encode()).hexdigest() and len(got) == 1 + 333
