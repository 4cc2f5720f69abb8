import zlib

from pyspark.sql import functions as F

from pagewright.llm.sharding import shard, shard_and_grow, sized, slot_bytes, slot_map, write_shards
from tests.llm.conftest import frame, messy_rows, words


def test_every_row_has_a_place(messy):
    got = shard(messy, 3, slots=64).collect()
    want = sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t, *_ in messy_rows())
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == want
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_are_near_equal_and_grow_with_few_moves(spark):
    docs = frame(spark, [(k, " ".join(words(k, 3 + 4000 // (1 + k))), "en", "a") for k in range(1500)])
    rows = sized(docs, 512)
    table = slot_map(slot_bytes(rows), 8, slots=512).cache()
    loads = [r[0] for r in table.groupBy("shard").agg(F.sum("bytes")).select("sum(bytes)").collect()]
    assert len(loads) == 8 and max(loads) <= 1.02 * min(loads) + 200
    grown = slot_map(slot_bytes(rows), 9, before=table, version=1, slots=512)
    both = table.alias("a").join(grown.alias("b"), "virtual_slot").select(F.col("a.shard").alias("old"), F.col("b.shard").alias("new"), "b.bytes", "b.version").collect()
    moved = sum(r["bytes"] for r in both if r["old"] != r["new"])
    assert moved < 0.2 * sum(loads) and {r["version"] for r in both} == {1} and len(both) == table.count() == 512
    assert max(sum(r["bytes"] for r in both if r["new"] == s) for s in range(9)) <= 1.2 * sum(loads) / 9
    fewer = slot_map(slot_bytes(rows), 7, before=table, version=2, slots=512)
    assert {r[0] for r in fewer.select("shard").distinct().collect()} == set(range(7))


def test_nothing(nothing):
    assert shard(nothing, 8).count() == 0


def test_written_shards_hold_all_columns(messy, tmp_path):
    first = messy.filter("doc_id < 5")
    table = slot_map(slot_bytes(sized(first, 64)), 3, slots=64)
    docs = messy.selectExpr("*", "'x' AS shard", "'y' AS virtual_slot")
    name = write_shards(docs, table, str(tmp_path / "s"), 64)  # rows of slots that were empty, too
    back = messy.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.count() == messy.count() and name == "_shard" and {*docs.columns, name} == set(back.columns)
    assert {r[0] for r in back.select("shard").distinct().collect()} == {"x"}


def test_the_edit_for_one_more_shard_is_that_of_brute_force(spark):
    docs = frame(spark, [(k, " ".join(words(k, 3 + 4000 // (1 + k))), "en", "a") for k in range(900)])
    got = shard_and_grow(docs, 4, 128).collect()
    load, old, new = {}, {}, {}
    for r in got:
        load[r["virtual_slot"]] = load.get(r["virtual_slot"], 0) + r["size"]
        old[r["virtual_slot"]], new[r["virtual_slot"]] = r["shard"], r["next_shard"]
    loads = {s: 0 for s in range(4)}
    for v in sorted(load, key=lambda v: (-load[v], v)):  # longest first, each to the least loaded
        least = min(loads, key=lambda s: (loads[s], s))
        assert old[v] == least
        loads[least] += load[v]
    share, stays, grown = sum(load.values()) / 5, {}, {s: 0 for s in range(5)}
    for s in range(4):
        running = 0
        for v in sorted((v for v in load if old[v] == s), key=lambda v: (-load[v], v)):
            running += load[v]
            if running <= share:
                stays[v] = s
                grown[s] += load[v]
    for v in sorted((v for v in load if v not in stays), key=lambda v: (-load[v], v)):
        least = min(grown, key=lambda s: (grown[s], s))
        assert new[v] == least
        grown[least] += load[v]
    assert all(new[v] == s for v, s in stays.items()) and {r["next_version"] for r in got} == {1}
    even = sum(r["size"] for r in got) / 4
    assert max(loads.values()) <= max(even + max(load.values()), 1)
