import hashlib
import random
import re

from pagewright.llm.exact_dedup import drop_copies, exact_dedup, frequent_digests
from pagewright.llm.shared import documents
from tests.llm.conftest import SCHEMA, frame, messy_rows


def brute(rows):
    groups = {}
    for k, (i, t, *_) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = rows[best[3]][0]
        out += [(rows[m[3]][0], keep, len(members), hashlib.sha256(text.encode()).hexdigest()) for m in members]
    return sorted(map(str, out)), len(groups)


def check(df, rows):
    got = exact_dedup(df, counters=8).collect()
    want, n = brute(rows)
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
    assert sum(r["kept"] for r in got) == n
    return got


def test_messy_rows(messy):
    check(messy, messy_rows())


def test_a_third_are_copies(spark):
    rnd = random.Random(1)
    rows = [(k, "hot text" if rnd.random() < 0.4 else f"text {rnd.randrange(300)}", "en", "a") for k in range(900)]
    got = check(frame(spark, rows), rows)
    assert any(r["frequent"] for r in got) and not all(r["frequent"] for r in got)


def test_misra_gries_names_every_frequent_digest(spark):
    rnd = random.Random(2)
    rows = [(bytearray(b"%d" % int(rnd.paretovariate(0.7))),) for _ in range(4000)]
    df = spark.createDataFrame(rows, "digest binary").repartition(7)
    counts = {}
    for (d,) in rows:
        counts[bytes(d)] = counts.get(bytes(d), 0) + 1
    named = {bytes(r[0]) for r in frequent_digests(df, 50).collect()}
    assert {d for d, n in counts.items() if n > 2 * len(rows) / 50} <= named and len(named) <= 50


def test_nothing(nothing):
    assert exact_dedup(nothing).count() == 0 and drop_copies(nothing).count() == 0


def test_dropping_keeps_columns_and_one_row_a_group(messy):
    left = drop_copies(messy)
    assert left.schema == messy.schema and left.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert left.count() == brute(messy_rows())[1]


def test_planted_copies_of_the_small_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check(docs, rows)
