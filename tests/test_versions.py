"""Versions of manifests."""

import threading

import pytest

from pagewright.schema import PAGE, SUBMISSION
from pagewright.sources import tables, versions
from pagewright.sources.storage import Storage


def rows(spark, *ids):
    return {"submissions.csv": (spark.createDataFrame([(i, "completed", "") for i in ids], SUBMISSION), ("submission_id",))}


def ids(spark, storage, prefix=""):
    return sorted(r["submission_id"] for r in tables.load_submissions(spark, storage, prefix).collect())


@pytest.mark.parametrize("prefix", ["", "deep/er"])
def test_one_of_two_writers_loses(spark, tmp_path, prefix):
    storage = Storage(str(tmp_path))
    assert versions.current(storage, prefix) == 0
    assert versions.publish(spark, storage, prefix, 0, rows(spark, "a", "b")) == 1
    with pytest.raises(versions.Conflict):
        versions.publish(spark, storage, prefix, 0, rows(spark, "c"))
    assert ids(spark, storage, prefix) == ["a", "b"] and versions.current(storage, prefix) == 1
    assert versions.publish(spark, storage, prefix, 1, rows(spark, "c")) == 2 and ids(spark, storage, prefix) == ["c"]
    assert not [p for p in storage.list_prefixes(f"{prefix}/_versions" if prefix else "_versions")]  # nothing staged is left


def test_a_version_comes_into_force_as_a_whole(spark, tmp_path, monkeypatch):
    """A writer that dies once its version counts, before or while files are moved: the next one moves them."""
    storage, settle, move = Storage(str(tmp_path)), versions._settle, Storage.move
    versions.publish(spark, storage, "", 0, rows(spark, "a"))
    both = rows(spark, "b") | {"pages.csv": (spark.createDataFrame([("b", "x", 1, "completed", "", "", "", "", 0, 0)], PAGE), ("submission_id",))}
    monkeypatch.setattr(versions, "_settle", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        versions.publish(spark, storage, "", 1, both)
    assert ids(spark, storage) == ["a"]
    monkeypatch.setattr(versions, "_settle", settle)
    moved = []

    def once(self, path, to):
        if moved:
            raise OSError("gone")
        moved.append(to)
        move(self, path, to)

    monkeypatch.setattr(Storage, "move", once)
    with pytest.raises(OSError, match="gone"):
        versions.current(storage)
    monkeypatch.setattr(Storage, "move", move)
    assert versions.current(storage) == 2 and ids(spark, storage) == ["b"] and tables.load_pages(spark, storage).count() == 1
    with pytest.raises(versions.Conflict):
        versions.publish(spark, storage, "", 1, rows(spark, "late"))


@pytest.mark.parametrize("by_hadoop", [False, True])
def test_one_put_of_many_wins(spark, tmp_path, by_hadoop):
    storage, won = Storage(str(tmp_path)), []
    put = versions._put_by_hadoop if by_hadoop else versions.put_if_absent

    def one(k):
        if put(spark, storage, "v/1.json", b"%d" % k):
            won.append(k)

    threads = [threading.Thread(target=one, args=(k,)) for k in range(1 if by_hadoop else 16)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and storage.read_text("v/1.json") == str(won[0])
    assert not put(spark, storage, "v/1.json", b"other") and storage.read_text("v/1.json") == str(won[0])


def test_old_records_go_and_numbers_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "KEPT", 2)
    storage = Storage(str(tmp_path))
    for k in range(4):
        versions.publish(spark, storage, "", k, rows(spark, str(k)))
    assert len(storage.list_files("_versions")) == 2 and versions.current(storage) == 4 and ids(spark, storage) == ["3"]


def test_parts_are_in_order_of_their_numbers(spark, tmp_path):
    names = ["parts/part-100000-a.csv", "parts/part-99999-a.csv", "parts/.part-00001-a.csv.crc", "parts/_SUCCESS", "part-00002"]
    assert [tables.part_number(n) for n in names] == [100000, 99999, -1, -1, 2]
    storage = Storage(str(tmp_path))
    many = spark.range(500).selectExpr("lpad(id, 5, '0') AS submission_id", "'completed' AS status", "'' AS error").repartition(40)
    tables.save_manifest(many, storage, "m.csv", ("submission_id",))
    got = storage.read_text("m.csv").split("\n")
    assert got[0] == "submission_id,status,error" and [x[:5] for x in got[1:-1]] == [f"{k:05}" for k in range(500)] and storage.list_prefixes() == []
