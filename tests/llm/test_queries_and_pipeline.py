"""Registered queries on the smallest tables, SQL where there is some, and the pipeline's stages in a row."""

import math
import re
import struct
import zlib
from collections import Counter
from itertools import accumulate

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pagewright.llm.language_id import identify
from pagewright.llm.queries import ORACLE_SQL, QUERIES
from pagewright.llm.shared import documents
from pagewright.llm.tokens import tokenizer_path
from tests.llm.conftest import messy_rows
from tests.llm.test_mixing import water
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_ngram_join import sets_of

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES)] == [list(range(1, 14))]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(str, want.select(*columns).fetchall()))


def test_op6_counts_what_is_left(spark):
    """Against the tokenizer over all documents, with the poor ones revised and the toxic ones left out."""
    direct, want = Tokenizer.from_file(tokenizer_path()), {}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    poor, toxic = {r["doc_id"] for r in labels if r["quality"] == 0}, {r["doc_id"] for r in labels if r["toxic"] == 1}
    assert poor - toxic and toxic
    for r in documents(spark, SF).collect():
        if r["doc_id"] not in toxic:
            text = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") if r["doc_id"] in poor else r["text"] or ""
            own = want.setdefault((r["source"], r["lang"]), [0, 0, 0])
            for k, n in enumerate((1, len(text), len(direct.encode(text, add_special_tokens=False).ids))):
                own[k] += n
    got = {(r["source"], r["lang"]): [r["documents"], r["characters"], r["tokens"]] for r in QUERIES["op6_token_counts"](spark, SF).collect()}
    assert got == want


def sources_rates(rows):
    """Targets and rates by bisection, for (source, size) rows."""
    sizes = {}
    for so, n in rows:
        sizes[so] = sizes.get(so, 0) + n
    want, rates = water(sizes), {}
    for so in sizes:
        own = sorted({n for s, n in rows if s == so and n})
        counts = {n: sum(s == so and x == n for s, x in rows) for n in own}
        low, high = -60.0, 60.0
        for _ in range(200):
            middle = (low + high) / 2
            words = sum(counts[n] * n * min(3, math.exp(min(50, middle * n / max(own)))) for n in own)
            low, high = (middle, high) if words < want[so] else (low, middle)
        for n in own:
            rates[so, n] = min(3, math.exp(min(50, high * n / max(own))))
    return want, rates


def test_stages_agree_with_brute_force(spark):
    """Each stage on what its predecessor kept, against a plain reckoning over all rows."""
    stages, docs, kept = dict(corpus_pipeline.STAGES), documents(spark, SF), {}
    every = [docs.collect()]
    for name in list(stages)[:-1]:
        docs = corpus_pipeline.written(stages[name](spark, docs, SF), f"test-{name}")
        kept[name] = docs.collect()
        every.append(kept[name])
    before = dict(zip(stages, every))
    assert list(stages) == ["language_id", "exact_dedup", "ngram_join", "mixing", "packing"]
    assert docs.columns == documents(spark, SF).columns and len(every[1]) >= 190 and len(every[1]) > len(every[2]) >= len(every[3])

    rejected = {r["doc_id"] for r in identify(documents(spark, SF)).collect() if r["rejected"]}  # its scores: see test_language_id
    assert sorted(r["doc_id"] for r in kept["language_id"]) == sorted(r["doc_id"] for r in before["language_id"] if r["doc_id"] not in rejected)

    groups = {}
    for r in before["exact_dedup"]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), []).append((-len(r["text"] or ""), r["doc_id"]))
    assert sorted(r["doc_id"] for r in kept["exact_dedup"]) == sorted(min(g)[1] for g in groups.values())

    told = brute_groups([(r["doc_id"], r["text"]) for r in before["ngram_join"]], 5, 80)
    stay = [r["doc_id"] for r in before["ngram_join"] if str((r["doc_id"], len(sets_of(r["text"], 5)), r["doc_id"])) in set(told)]
    assert sorted(r["doc_id"] for r in kept["ngram_join"]) == sorted(stay)

    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in before["mixing"]}
    want, rates = sources_rates([(r["source"], size[r["doc_id"]]) for r in before["mixing"]])
    copies = Counter(r["doc_id"] for r in kept["mixing"])
    taken = Counter()
    for r in before["mixing"]:
        n, rate = copies[r["doc_id"]], rates.get((r["source"], size[r["doc_id"]]), 1)
        taken[r["source"]] += n * size[r["doc_id"]]
        assert math.floor(rate + 1e-6) <= n <= math.ceil(rate - 1e-6)
    for so in want:  # as near as whole documents come: half of the shortest that can change
        able = [size[r["doc_id"]] for r in before["mixing"] if r["source"] == so and 1e-6 < rates.get((so, size[r["doc_id"]]), 1) % 1 < 1 - 1e-6]
        assert abs(taken[so] - want[so]) <= max(able, default=0) / 2 + 1
    assert {tuple(r) for r in kept["mixing"]} <= {tuple(r) for r in before["mixing"]}

    direct = Tokenizer.from_file(tokenizer_path())
    pieces = []
    for r in before["packing"]:
        ids = [*direct.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        pieces += [(r["doc_id"], k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(struct.pack(f"<{len(ids[k : k + 4096])}I", *ids[k : k + 4096]))) for k in range(0, len(ids), 4096)]
    packed = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(pieces)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        ends = [0, *accumulate(n for _, n in sorted(own))]
        assert [at for at, _ in sorted(own)] == ends[:-1] and ends[-1] <= 4096
    rooms = []  # first fit, longest first
    for n in sorted((p[3] for p in pieces), reverse=True):
        k = next((k for k, room in enumerate(rooms) if room >= n), None)
        if k is None:
            rooms.append(4096 - n)
        else:
            rooms[k] -= n
    assert len(bins) <= len(rooms)


def test_stages_take_messy_rows_and_none(spark, messy, nothing):
    for start in (messy, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
            assert name == "packing" or docs.columns == start.columns
        assert (docs.count() > 0) == (start is messy)
    assert len(messy_rows()) == messy.count()
