"""Work queues, roll-ups and upserts on small cases."""

import datetime as dt

from pyspark.sql import functions as F

from pagewright.operators import relational as R
from pagewright.plans import consumer

PAGE = "submission_id string, doc_filename string, page_number int, status string, error string, image_filename string"


def test_work_queue_takes_what_is_not_completed(spark):
    found = spark.createDataFrame([("a", "x/a"), ("b", "x/b"), ("c", "x/c")], "submission_id string, source_path string")
    manifest = spark.createDataFrame([("a", "completed"), ("b", "failed"), ("gone", "completed")], "submission_id string, status string")
    queue = R.work_queue(found, manifest)
    assert sorted(r[0] for r in queue.collect()) == ["b", "c"]
    assert R.work_queue(found, manifest, force=True).count() == 3
    assert sorted(r[0] for r in R.carried(manifest, queue).collect()) == ["a", "gone"]
    assert [r[0] for r in R.first_by_path(found, 2).collect()] == ["a", "b"]


def test_roll_up(spark):
    long = "e" * 400
    pages = [
        ("ok", "d", 1, "completed", "", "d_p1.jpg"),
        ("some", "d", 1, "completed", "", "d_p1.jpg"),
        ("some", "d", 2, "failed", "bad", "d_p2.jpg"),
        ("some", "f", 3, "failed", "bad", ""),
        ("all", "d", 2, "failed", "second", "x"),
        ("all", "d", 1, "failed", "first", "x"),
        ("all", "d", 3, "failed", "", "x"),
        ("long", "d", 1, "failed", long, ""),
        ("long", "d", 2, "failed", long, ""),
        ("blank", "d", 1, "failed", "", ""),
    ]
    work = spark.createDataFrame([(i,) for i in ("ok", "some", "all", "long", "blank", "none")], "submission_id string")
    got = {r["submission_id"]: (r["status"], r["error"]) for r in R.roll_up(work, spark.createDataFrame(pages, PAGE)).collect()}
    assert got["ok"] == got["none"] == ("completed", "")
    assert got["some"] == ("completed", "Some pages failed: d_p2.jpg, f")
    assert got["all"] == ("failed", "first; second")
    assert got["long"] == ("failed", f"{long}; {long}"[:500])
    assert got["blank"] == ("failed", "")


def test_upsert_keeps_duplicates_and_takes_last_update(spark):
    rows = spark.createDataFrame([("a", 1, "old"), ("a", 1, "old"), ("b", 1, "old")], "id string, n int, v string")
    updates = spark.createDataFrame([("a", 1, "first", 0), ("a", 1, "last", 1), ("z", 1, "new", 2)], "id string, n int, v string, k int")
    got = sorted(tuple(r) for r in R.upserted(rows, updates, ("id", "n"), order="k").collect())
    assert got == [("a", 1, "last"), ("a", 1, "last"), ("b", 1, "old")]


def test_stall_gaps_look_over_midnight(spark):
    at = lambda *a: dt.datetime(2024, 1, *a)
    events = spark.createDataFrame([(1, at(1, 23, 50)), (2, at(1, 23, 51)), (3, at(3, 0, 0)), (4, at(3, 0, 1, 30))], "event_id long, ts timestamp")
    got = sorted((r["event_id"], r["gap"], r["aborts"]) for r in R.stall_gaps(events).collect())
    assert got == [(3, 24 * 3600 + 540, True), (4, 90, False)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], PAGE)
    work = spark.createDataFrame([], "submission_id string")
    assert R.roll_up(work, none).count() == 0
    assert R.colliding_names(none).count() == 0


def test_tree_in_order_over_tasks_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(consumer, "TREE_ROWS", 500)
    subs = spark.range(600).selectExpr("id AS submission_id", "'completed' AS status")
    pages = spark.range(4000).selectExpr("id * 37 % 590 AS submission_id", "concat(id * 7 % 3, '.pdf') AS doc_filename", "CAST(id * 11 % 13 AS INT) AS page_number", "concat(id, '.jpg') AS image_filename", "'' AS lines_filename")
    found = consumer.tree(subs, pages)
    rows = [tuple(r) for r in found.select("submission_id", "doc_filename", "page_number", "image_filename", "document", "place").collect()]
    by, want = {}, []
    for r in pages.collect():
        by.setdefault(r[0], []).append(r)
    for s in range(600):
        own = sorted(tuple(r)[1:4] for r in by.get(s, ()))
        names = sorted({d for d, *_ in own})
        want += [(s, d, n, i, names.index(d), [x for x in own if x[0] == d].index((d, n, i))) for d, n, i in own] or [(s, None, None, None, None, None)]
    assert rows == want
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 1500
