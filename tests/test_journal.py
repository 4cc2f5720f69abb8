"""Runs that end too early, and are carried on."""

import functools
import json
import logging
import time
from dataclasses import replace

import pytest

from pagewright.operators.imaging import RECORDED, Providers, extracted
from pagewright.plans import runs
from pagewright.settings import Settings, Side
from pagewright.sources import tables, versions
from pagewright.sources.journal import Journal
from pagewright.sources.storage import Storage
from pagewright.streaming import incremental
from tests import fakes
from tests.test_runs import doc, manifest

NOTED = Providers(fakes.Noted, fakes.Images, fakes.Detector)


@pytest.fixture
def noted(tmp_path):
    """Four submissions of two documents; each page is noted once it is made."""
    source, target, log = Storage(str(tmp_path / "in")), Storage(str(tmp_path / "out")), tmp_path / "log"
    for s in ("a", "b", "c", "d"):
        source.write_text(f"{s}/desc.json", json.dumps({"files": [doc("x.pdf", ".pdf"), doc("y.pdf", ".pdf")]}))
        for d in ("x", "y"):
            source.write_text(f"{s}/{d}.pdf", f"PDF\nnote {log} {s}{d}1\nnote {log} {s}{d}2")
    settings = Settings(Side("local", str(tmp_path / "in")), Side("local", str(tmp_path / "out")))
    return source, target, settings, lambda: sorted(log.read_text().split())


ALL = sorted(f"{s}{d}{n}" for s in "abcd" for d in "xy" for n in (1, 2))


def test_a_run_that_dies_is_carried_on_without_making_a_page_twice(spark, noted, monkeypatch):
    _, target, settings, made = noted

    def die(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "publish", die)
    with pytest.raises(KeyboardInterrupt):
        runs.run(spark, settings, NOTED)
    monkeypatch.undo()
    assert made() == ALL and not target.exists("pages.csv")
    assert runs.run(spark, settings, NOTED) == {"submissions": 4, "completed": 4, "failed": 0, "pages": 16}
    assert made() == ALL
    subs, pages = manifest(spark, target)
    assert len(subs) == 4 and len(pages) == 16 and pages["a", "x.pdf", 2]["raw_image_width"] == 30
    assert not target.walk("", "nothing") and not [p for p in runs._journal(target, "", replace(NOTED, options=runs.Options(settings.max_dimension))).load(spark, RECORDED).collect()]


def test_changed_files_other_options_and_forced_runs_begin_anew(spark, noted, monkeypatch):
    source, _, settings, made = noted
    monkeypatch.setattr(versions, "publish", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, settings, NOTED)
    log = source.read_text("a/x.pdf").split()[2]
    source.write_text("a/x.pdf", f"PDF\nnote {log} new")
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, settings, NOTED)
    assert made() == sorted([*ALL, "new"])
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, replace(settings, max_dimension=77), NOTED)
    again = [x for x in ALL if x[:2] != "ax"]
    assert made() == sorted([*ALL, "new", "new", *again])
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, replace(settings, force_reprocess=True), NOTED)
    assert made() == sorted([*ALL, "new", "new", "new", *again, *again])


def test_a_stuck_document_is_told_and_the_rest_is_published(spark, noted, monkeypatch, caplog):
    """What has ended is in the manifests, the stuck document is in the warning and the error, and the next run makes what is left."""
    source, target, settings, made = noted
    monkeypatch.setattr(runs, "watched", functools.partial(incremental.watched, poll=0.5))
    good = source.read_text("c/y.pdf")
    source.write_text("c/y.pdf", "PDF\nwait 600")
    with caplog.at_level(logging.WARNING), pytest.raises(incremental.Stalled, match="c/y.pdf") as stalled:
        runs.run(spark, replace(settings, stall_warning=8, stall_timeout=24), NOTED)
    assert stalled.value.in_flight == ["c/y.pdf"] and "in flight: c/y.pdf" in caplog.text
    subs, pages = manifest(spark, target)
    assert subs.keys() <= {"a", "b", "d"} and len(pages) == 4 * len(subs)  # others may wait behind it
    source.write_text("c/y.pdf", good)
    left = 4 - len(subs)
    assert runs.run(spark, settings, NOTED) == {"submissions": left, "completed": left, "failed": 0, "pages": 4 * left}
    assert made() == ALL and len(manifest(spark, target)[0]) == 4


def test_a_long_task_that_gets_on_is_not_ended(spark, tmp_path):
    """One task with many slow documents, together far over the limit."""
    source, target = Storage(str(tmp_path / "in")), Storage(str(tmp_path / "out"))
    for k in range(20):
        source.write_text(f"s{k}/x.pdf", "PDF\nwait 0.6")
    docs = spark.createDataFrame([(f"s{k}", f"s{k}", "x.pdf", 0, True, None) for k in range(20)], "submission_id string, source_path string, doc_filename string, position int, pdf boolean, cached string").coalesce(1)
    journal, warned = Journal(target, "_journal/t"), []
    began = time.monotonic()
    n = incremental.watched(spark, lambda: extracted(docs, NOTED, source, target, journal=journal).count(), 8, 11, lambda s, ids: warned.append(ids), poll=0.3, progress=journal.progress)
    assert n == 20 and time.monotonic() - began > 11 and not warned
    assert journal.progress() == ((), []) and journal.load(spark, RECORDED).count() == 20
    journal.forget(docs.limit(5))
    assert journal.load(spark, RECORDED).count() == 15
    journal.clear()
    assert journal.load(spark, RECORDED).count() == 0


def test_two_writers_of_one_state(spark, noted, monkeypatch):
    """A run during which another has published loses with an error, and makes its pages no second time."""
    source, target, settings, made = noted
    publish = versions.publish

    def late(spark, storage, prefix, base, manifests, state=None):
        other = {"submissions.csv": (spark.createDataFrame([("z", "completed", "")], tables.SUBMISSION), ("submission_id",))}
        monkeypatch.setattr(versions, "publish", publish)
        publish(spark, storage, prefix, base, other)
        return publish(spark, storage, prefix, base, manifests, state)

    monkeypatch.setattr(versions, "publish", late)
    with pytest.raises(versions.Conflict):
        runs.run(spark, settings, NOTED)
    assert manifest(spark, target)[0].keys() == {"z"} and not target.exists("pages.csv")
    runs.run(spark, settings, NOTED)
    assert manifest(spark, target)[0].keys() == set("abcdz") and made() == ALL
