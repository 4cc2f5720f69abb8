import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagewright.llm.packing import best_fit, pack, plan, reduce_by_dominance, sequences
from pagewright.llm.shared import documents
from pagewright.llm.tokens import encoder, tokenizer_path
from tests.llm.conftest import messy_rows


def fewest(items, capacity):
    """Fewest bins by search; for few items."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        seen = set()
        for i, b in enumerate(bins):
            if b + items[k] <= capacity and b not in seen:
                seen.add(b)
                bins[i] += items[k]
                go(k + 1, bins)
                bins[i] -= items[k]
        bins.append(items[k])
        go(k + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_loses_no_optimum(items):
    counts = {v: items.count(v) for v in set(items)}
    fixed, left = reduce_by_dominance(counts, 20)
    assert all(sum(s) <= 20 for s, _ in fixed)
    rest = [v for v, n in left.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + (fewest(rest, 20) if rest else 0) == fewest(items, 20)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), min_size=1, max_size=20))
def test_best_fit_places_all_and_overfills_none(counts):
    placed = {}
    for pattern, n in best_fit(counts, 50):
        assert 0 < sum(v * t for v, t in pattern) <= 50
        for v, t in pattern:
            placed[v] = placed.get(v, 0) + t * n
    assert placed == counts
    plan(counts, 50)


def test_best_fit_is_that_of_single_pieces():
    rnd = random.Random(3)
    for _ in range(30):
        counts = {rnd.randint(1, 40): rnd.randint(1, 9) for _ in range(8)}
        rooms = []
        for v in sorted((v for v, n in counts.items() for _ in range(n)), reverse=True):
            fit = [r for r in rooms if r >= v]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - v)
            else:
                rooms.append(40 - v)
        assert sum(n for _, n in best_fit(counts, 40)) <= len(rooms) + 1


def test_ids_are_those_of_the_tokenizer(spark):
    own, direct = encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    texts = [r[0] for r in documents(spark, "/root/testdata/sf0.001").select("text").collect()] + [t or "" for _, t, *_ in messy_rows()]
    texts += ["don't WE'LL 's 'm re'", "a\x85b\xa0c \x1c d", "²³ 12 x_y ªº", "<|endoftext|> a <|x", "Ǆ ŉ ĳ İ ı"]
    for t in texts:
        assert own(t) == b"".join(i.to_bytes(4, "little") for i in direct.encode(t, add_special_tokens=False).ids)


def check(got, rows, capacity):
    direct = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in rows:
        ids = [*direct.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append(str((i, k, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))))
    assert sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_messy_rows(messy):
    rows = [(i, t) for i, t, *_ in messy_rows()]
    check(pack(messy).collect(), rows, 4096)
    got = pack(messy, capacity=64, with_ids=True)
    n = check(got.collect(), rows, 64)
    whole = sequences(got).collect()
    assert len(whole) == n and all(len(r["ids"]) <= 64 for r in whole)


def test_small_table_is_packed_tight(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    got = pack(docs).collect()
    n = check(got, [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)
    assert n <= -(-sum(r["length"] for r in got) // 4096) + 1


def test_nothing(nothing):
    assert pack(nothing).count() == 0
