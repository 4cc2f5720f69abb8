import random

from pagewright.llm import ngram_join as J
from pagewright.llm.ngram_join import drop_near_copies, needed, ngram_join, shingles
from pagewright.llm.shared import documents
from tests.llm.conftest import frame, messy_rows, words


def sets_of(text, k):
    own = (text or "").encode().lower().split()
    return frozenset(tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))) if own else frozenset()


def brute(rows, k, percent):
    """Group of each row by comparing all pairs."""
    sets = [sets_of(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for x, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return sorted(str((rows[x][0], len(sets[x]), least.get(find(x)) if sets[x] else rows[x][0])) for x in range(len(rows)))


def check(df, rows, k=4, percent=85):
    got = ngram_join(df, k, percent).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == brute(rows, k, percent)


def test_messy_rows(messy):
    check(messy, messy_rows())
    check(messy, messy_rows(), 5, 80)


def test_small_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def crowd(seed, n):
    """Copies at all distances, chains, shared passages, short texts, many of one group."""
    rnd = random.Random(seed)
    passage, base = words(1000 + seed, 40), words(2000 + seed, 80)
    rows = []
    for k in range(n):
        kind = rnd.random()
        if kind < 0.35:
            text = list(base)
            for _ in range(rnd.randint(0, 4)):
                text[rnd.randrange(len(text))] = f"e{rnd.randrange(9)}"
        elif kind < 0.5:
            text = base[: rnd.randint(60, 80)]
        elif kind < 0.8:
            text = [*words(k, rnd.randint(0, 60)), *passage, *words(k + 1, rnd.randint(0, 40))]
        else:
            text = rnd.choices(["a", "b", "c"], k=rnd.randint(1, 6))
        rows.append((k, " ".join(text), "en", "a"))
    return rows


def test_crowds_lose_no_link(spark, monkeypatch):
    for seed, cost in ((1, 500), (3, 0)):  # with small costs most nodes get the longest prefix
        monkeypatch.setattr(J, "COST", cost)
        rows = crowd(seed, 260)
        check(frame(spark, rows), rows)


def loose(seed, n, least=0, most=16, length=300, source=0):
    """Copies of one text with ``least`` to ``most`` words changed, each apart from the others."""
    rnd = random.Random(seed)
    base = words(7000 + source, length, 10**9)
    rows = []
    for k in range(n):
        text = list(base)
        for at in rnd.sample(range(length), rnd.randint(least, most)):
            text[at] = f"e{rnd.randrange(10**6)}"
        rows.append((k, " ".join(text[: length - rnd.choice([0, 0, 0, rnd.randrange(30)])]), "en", "a"))
    return rows


def test_loose_groups_lose_no_link(spark, monkeypatch):
    """Groups without their source and of two sources, also where sets stand for a few nodes only, and hot shingles are dealt out."""
    monkeypatch.setattr(J, "COST", 20)
    for seed, least, members, hot in ((1, 3, 16, 2000), (2, 4, 2, 7), (3, 0, 10**6, 50)):
        monkeypatch.setattr(J, "MEMBERS", members)
        monkeypatch.setattr(J, "HOT", hot)
        rows = loose(seed, 110, least, 12, 150)
        half = loose(seed + 50, 40, least, 9, 150, source=1)
        mixed = [(1000 + k, " ".join(half[k][1].split()[: 75 + k] + rows[k][1].split()[75 + k :]), "en", "a") for k in range(40)]
        rows += [(500 + i, t, *more) for i, t, *more in half] + mixed
        check(frame(spark, rows), rows)


def test_loose_groups_without_pivots(spark, monkeypatch):
    """What the search between groups must find by itself."""
    real = J._against_pivots
    monkeypatch.setattr(J, "_against_pivots", lambda *a: real(*a).limit(0))
    monkeypatch.setattr(J, "COST", 20)
    for seed, percent, members in ((1, 85, 4), (2, 40, 3)):
        monkeypatch.setattr(J, "MEMBERS", members)
        rows = loose(seed, 80, 1, 14, 90) + [(500 + i, t, *more) for i, t, *more in loose(seed + 9, 30, 0, 9, 90, source=1)]
        check(frame(spark, rows), rows, 3, percent)


def test_candidates_of_loose_groups_grow_in_proportion(spark):
    counts = []
    for n in (300, 600, 1200):
        join = J.Join(frame(spark, loose(5, n)), 4, 85)
        join.groups()
        counts.append(sum(pairs.count() for pairs in join.candidates))
    assert counts[1] <= 2.5 * counts[0] and counts[2] <= 2.5 * counts[1]


def test_blends_of_large_groups_are_not_held_against_all_of_them(spark, monkeypatch):
    """Texts of two sources are near no set that stands for many; what stands for the sources already has all that may be similar to them."""
    monkeypatch.setattr(J, "COST", 20)
    real, bare = J._by_difference, []

    def seen(deltas, percent):
        bare.extend(r["node"] for r in deltas.filter("hub < 0").select("node").distinct().collect())
        return real(deltas, percent)

    monkeypatch.setattr(J, "_by_difference", seen)
    first, second = loose(21, 60, 0, 5, 150), loose(22, 60, 0, 5, 150, source=1)
    blends = [(3000 + k, " ".join(first[k][1].split()[: 60 + k] + second[k][1].split()[60 + k :]), "en", "a") for k in range(12)]
    rows = [*first, *((1000 + i, *more) for i, *more in second), *blends]
    check(frame(spark, rows), rows, 5, 80)
    assert 0 < len(bare) <= 2 * len(blends)  # of 132 nodes


def test_growing_versions_meet_without_pivots(spark, monkeypatch):
    real = J._against_pivots
    monkeypatch.setattr(J, "_against_pivots", lambda *a: real(*a).limit(0))
    rows = []
    for k in range(60):  # the later version has the earlier one in it, and as many more shingles as 85% allows, or one too many
        text = words(5000 + k, 122, 10**9)
        rows += [(2 * k, " ".join(text[:103]), "en", "a"), (2 * k + 1, " ".join(text[: 121 if k % 10 == 0 else 120 - k % 4]), "en", "a")]
    check(frame(spark, rows), rows)


def test_shuffled_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST", 0)
    rows = crowd(4, 150)
    check(frame(spark, rows), rows, 5, 80)


def test_needed_is_the_least_overlap():
    for n in range(1, 200):
        assert 100 * needed(n, 85) >= 85 * n > 100 * (needed(n, 85) - 1)


def test_shingles_count_distinct_runs():
    for text in ("", " ", "a", "a b c", "A b c d", "a b c d e a b c d e", "x y z", "É é"):
        assert len(shingles(text, 4)) == len(sets_of(text, 4))
    assert (shingles("A b", 4) == shingles("a  B\n", 4)).all() and not (shingles("É", 4) == shingles("é", 4)).all()


def test_one_of_each_group_stays(messy):
    left = drop_near_copies(messy)
    assert left.schema == messy.schema
    kept = [r["doc_id"] for r in left.collect()]
    assert 1 in kept and 2 not in kept and 4 not in kept and {5, 6, 7} <= set(kept) and kept.count(None) == 2


def test_nothing(nothing):
    assert ngram_join(nothing, 4, 85).count() == 0 and drop_near_copies(nothing).count() == 0
