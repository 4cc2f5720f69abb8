"""Manifests in buckets."""

import uuid
from dataclasses import replace

import pytest

from pagewright.operators import relational as R
from pagewright.plans import runs
from pagewright.settings import read_settings
from pagewright.sources import state, versions
from tests.test_journal import NOTED, noted  # noqa: F401
from tests.test_runs import manifest


def name():
    return f"t_{uuid.uuid4().hex}"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def told(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture
def kept_rows(spark):
    rows = spark.range(3000).selectExpr("IF(id % 500 = 7, NULL, concat('s', id % 1500)) AS submission_id", "IF(id % 3 = 0, 'failed', 'completed') AS status", "CAST(id AS string) AS error")
    return rows, state.save(rows, name(), 16)


def test_carried_rows_are_those_of_the_plain_join(spark, kept_rows):
    rows, table = kept_rows
    for ids in ("id % 7 = 0", "id < 3", "id < 0", "id >= 0"):
        work = spark.range(1600).filter(ids).selectExpr("concat('s', id) AS submission_id").union(spark.createDataFrame([("s3",), (None,)], "submission_id string").filter("submission_id IS NULL OR 1 = 0"))
        want = told(R.carried(rows, work))
        assert told(state.carried(table, work)) == want
        assert told(state.carried(table, work, bits=1 << 15)) == want  # a filter that lets many through


def test_the_kept_side_is_not_moved(spark, kept_rows):
    """No exchange stands over the table: not for carrying, not for the work queue, not for the last row of each key."""
    _, table = kept_rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = spark.range(50).selectExpr("concat('s', id) AS submission_id", "'x' AS source_path")
        for df, moved in ((state.carried(table, work), "range"), (R.work_queue(work, table), "range"), (R.last_wins(table, ("submission_id",), "error"), None)):
            text = plan(df)
            assert "Bucketed: true" in text
            lines = text.split("\n")
            for k, line in enumerate(lines):
                if "FileScan" in line:
                    depth, above = len(line) - len(line.lstrip(" :+-*()0123456789")), []
                    for up in reversed(lines[:k]):
                        d = len(up) - len(up.lstrip(" :+-*()0123456789"))
                        if d < depth:
                            depth = d
                            above.append(up)
                    assert not any("Exchange hashpartitioning" in up for up in above), text
            assert (moved is None) == ("Exchange hashpartitioning" not in text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_filter_holds_all_its_ids(spark):
    ids = spark.range(20_000).selectExpr("concat('s', id) AS submission_id")
    other = spark.range(20_000).selectExpr("concat('t', id) AS submission_id")
    maps = state.id_filter(ids, bits=1 << 20)
    assert state.marked(ids, maps, bits=1 << 20).filter("NOT _maybe").count() == 0
    assert state.marked(other, maps, bits=1 << 20).filter("_maybe").count() < 20_000 * 0.03
    assert maps.count() <= 32 and state.marked(other, state.id_filter(ids.limit(0)), bits=state.BITS).filter("_maybe").count() == 0


def test_runs_with_and_without_tables_agree(spark, noted, monkeypatch):  # noqa: F811
    source, target, settings, _ = noted
    own = replace(settings, state=name())
    runs.run(spark, replace(own, max_submissions=2), NOTED)
    first = versions.latest(target)["state"]
    assert set(first) == {"submissions", "pages"} and spark.table(first["pages"]).count() == 8

    def unread(*_):
        raise AssertionError("the CSV is not read where the tables are")

    monkeypatch.setattr(runs.tables, "load_submissions", unread)
    monkeypatch.setattr(runs.tables, "load_pages", unread)
    assert runs.run(spark, own, NOTED)["submissions"] == 2
    monkeypatch.undo()
    second = versions.latest(target)["state"]
    assert not spark.catalog.tableExists(first["pages"]) and spark.table(second["pages"]).count() == 16
    texts = {n: target.read_text(n) for n in ("submissions.csv", "pages.csv")}
    assert len(manifest(spark, target)[0]) == 4
    state.drop(spark, second)  # another session: the CSV is read
    runs.run(spark, replace(settings, force_reprocess=True), NOTED)
    assert {n: target.read_text(n) for n in texts} == texts and versions.latest(target)["state"] == {}


def test_tables_are_asked_for_by_a_setting():
    env = {f"{side}_STORAGE_{k}": v for side in ("SOURCE", "TARGET") for k, v in (("TYPE", "local"), ("PATH", "/x"))}
    assert read_settings(env).state is None and read_settings(env | {"PAGEWRIGHT_STATE": "db.m"}).state == "db.m"
