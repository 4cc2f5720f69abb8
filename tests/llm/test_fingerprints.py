import hashlib
import random
import re

import xxhash

from pagewright.llm import fingerprints
from pagewright.llm.fingerprints import fingerprint, search
from tests.llm.conftest import frame, messy_rows, words


def brute(text):
    votes, total = [0] * 128, 0
    second = xxhash.xxh64(b"second", seed=42).intdigest()
    for w in re.split(r"[\x20\x09-\x0D]+", text):
        weight = min(len(w), 8) ** 2
        total += weight
        for k, seed in enumerate((42, second)):
            h = xxhash.xxh64(w.encode(), seed=seed).intdigest()
            for b in range(64):
                votes[64 * k + b] += weight * (h >> b & 1)
    return "".join(f"{sum((votes[64 * k + b] * 2 > total) << b for b in range(64)):016x}" for k in (0, 1))


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def check(df, rows):
    got = {r["doc_id"]: r for r in fingerprint(df).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for k, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + nxt[:third]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (brute(t), brute(edited))
        assert r["near_edited"] == likeness(brute(t), brute(edited)) and r["near_next"] == likeness(brute(t), brute(nxt))
    assert len(got) == len(rows)


def unique(rows):
    return [r for k, r in enumerate(rows) if r[0] is not None and r[0] not in {x[0] for x in rows[:k]}]


def test_messy_rows(spark, messy):
    rows = unique(messy_rows())
    check(frame(spark, rows), rows)
    assert fingerprint(messy).count() == len(messy_rows())


def test_neighbours_across_ranges_and_gaps(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE", 7)
    rnd = random.Random(5)
    ids = {*rnd.sample(range(200), 90), 10**15, -(10**12), *range(10**9, 10**9 + 60)}
    rows = [(i, " ".join(words(i, rnd.randint(0, 12))), "en", "a") for i in ids]
    check(frame(spark, rows), rows)


def test_one_document_is_its_own_neighbour(spark):
    check(frame(spark, [(3, "abc def ghi", "en", "a")]), [(3, "abc def ghi", "en", "a")])


def test_nothing(nothing):
    assert fingerprint(nothing).count() == 0


def test_search_finds_all_within_the_radius(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(128) for _ in range(60)]
    near = [b ^ sum(1 << k for k in rnd.sample(range(128), rnd.randint(0, 9))) for b in base for _ in range(3)]
    every = [f"{v:032x}" for v in [*base, *near]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(every)], "doc_id long, fingerprint string")
    queries = df.filter("doc_id % 20 = 0")
    got = {(r["fingerprint"], r["near"]): r["distance"] for r in search(queries, df, radius=6).collect()}
    want = {}
    for q in every[::20]:
        for v in every:
            if (d := (int(q, 16) ^ int(v, 16)).bit_count()) <= 6:
                want[q, v] = d
    assert got == want
