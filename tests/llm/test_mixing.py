import math
import re

import pytest

from pagewright.llm.mixing import mix, mixed
from tests.llm.conftest import frame, messy_rows, words


def water(sizes, cap=3):
    """Targets by weights 1, 2, 3 over sources in order, resharing what is over the cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > cap * sizes[s] + 1e-9}
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free -= over
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(df, rows):
    got = mix(df).collect()
    sizes = {}
    for _, t, _, so in rows:
        sizes[so] = sizes.get(so, 0) + size(t)
    want = water(sizes)
    assert len(got) == len(rows)
    assert sorted(str((r["doc_id"], r["size"])) for r in got) == sorted(str((i, size(t))) for i, t, *_ in rows)
    for so in sizes:
        own = [r for r in got if r["source"] == so]
        assert all(r["source_size"] == sizes[so] and math.isclose(r["target"], want[so], abs_tol=1e-6) for r in own)
        assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in own)
    return got, want


def test_messy_rows(messy):
    check(messy, messy_rows())


def test_targets_are_met_and_capped(spark):
    import random

    rnd = random.Random(4)
    rows = []
    for k in range(3000):
        so = rnd.choices(["hot", "b", "c", "tiny", None], [30, 10, 10, 1, 5])[0]
        rows.append((k, " ".join(words(k, int(rnd.paretovariate(0.9) * 5) % 800 + 1)), "en", so))
    got, want = check(frame(spark, rows), rows)
    for so, target in want.items():
        own = [r for r in got if r["source"] == so]
        assert abs(sum(r["taken"] for r in own) - target) <= 0.01 * target + 2
    assert any(math.isclose(want[so], 3 * next(r["source_size"] for r in got if r["source"] == so)) for so in want)
    again = mix(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_copies_follow_the_rates(spark):
    """By deciles of the rate and by classes of size, on documents of very unequal sizes that are rarely equally long."""
    import random

    rnd = random.Random(11)
    rows = []
    for k in range(12_000):
        so = rnd.choices(["hot", "b", "c"], [60, 10, 10])[0]
        rows.append((k, "w " * min(20_000, int(rnd.paretovariate(1.1) * 30)), "en", so))
    got, want = check(frame(spark, rows), rows)
    for so, target in want.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == so) - target) <= 0.001 * target + 1
    by_rate = sorted(got, key=lambda r: (r["rate"], r["doc_id"]))
    for at in range(0, len(got), len(got) // 10):
        own = by_rate[at : at + len(got) // 10]
        assert abs(sum(r["copies"] for r in own) - sum(r["rate"] for r in own)) <= 0.05 * sum(r["rate"] for r in own) + 2
    for low, high in ((1, 50), (50, 100), (100, 300), (300, 1000), (1000, 20_001)):
        own = [r for r in got if low <= r["size"] < high]
        expected = sum(r["rate"] * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - expected) <= 0.02 * expected + high
    whole = [r for r in got if r["copies"] not in (math.floor(r["rate"]), math.ceil(r["rate"]))]
    assert not [r for r in whole if abs(r["rate"] - round(r["rate"])) > 1e-6]


def test_rates_are_the_entropy_balance(spark):
    """Rates are exp(multiplier * size) up to the cap, with the words expected at the target."""
    rows = [(k, " ".join(["w"] * (1 + k % 40)), "en", "ab"[k % 2]) for k in range(400)]
    got = mix(frame(spark, rows)).collect()
    for so in "ab":
        own = {r["size"]: r["rate"] for r in got if r["source"] == so}
        total = sum(r["rate"] * r["size"] for r in got if r["source"] == so)
        assert math.isclose(total, next(r["target"] for r in got if r["source"] == so), rel_tol=1e-6)
        slopes = [math.log(v) / s for s, v in own.items() if v < 3 - 1e-9]
        assert max(slopes) - min(slopes) < 1e-6


def test_given_weights_and_words(spark):
    rows = [(k, "one two three four", "en", "ab"[k % 2]) for k in range(200)]
    weights = spark.createDataFrame([("a", 3.0)], "source string, weight double")
    got = mix(frame(spark, rows), weights, words=600).collect()
    assert sum(r["taken"] for r in got if r["source"] == "a") == pytest.approx(600, abs=4)
    assert sum(r["taken"] for r in got if r["source"] == "b") == 0


def test_mixed_rows_keep_their_columns(messy):
    out = mixed(messy)
    assert out.schema == messy.schema
    assert out.count() == sum(r["copies"] for r in mix(messy).collect())


def test_mixed_rows_are_those_that_mix_takes(spark):
    """Also where columns have the names that the operator uses itself, and rows are repeated."""
    rows = [(k % 150, " ".join(words(k % 150, 1 + k % 7)), "en", "ab"[k % 2]) for k in range(300)]
    docs = frame(spark, rows).selectExpr("*", "1 AS copies", "2 AS lot", "3 AS KEY", "4 AS salt", "5 AS `_copies`", "6 AS time", "7 AS base")
    times = {}
    for r in mix(docs).collect():
        times[r["doc_id"], r["source"], r["size"]] = times.get((r["doc_id"], r["source"], r["size"]), 0) + r["copies"]
    out = {}
    for r in mixed(docs).collect():
        assert (r["copies"], r["lot"], r["KEY"], r["base"]) == (1, 2, 3, 7)
        out[r["doc_id"], r["source"], size(r["text"])] = out.get((r["doc_id"], r["source"], size(r["text"])), 0) + 1
    assert out == {k: n for k, n in times.items() if n}


def test_nothing(nothing):
    assert mix(nothing).count() == 0 and mixed(nothing).count() == 0
