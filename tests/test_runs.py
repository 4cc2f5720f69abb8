"""Whole runs over a generated tree, with providers that need no image library."""

import datetime as dt
import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pagewright.operators.imaging import Providers, cached_first, patch_lines
from pagewright.plans import consumer, runs
from pagewright.settings import Settings, Side
from pagewright.sources import tables
from pagewright.sources.storage import Storage
from pagewright.streaming import incremental
from tests import fakes

PROVIDERS = Providers(fakes.Pages, fakes.Images, fakes.Detector)


def doc(name, extension, **more):
    return {"stored_filename": name, "file_extension": extension, "mime_type": None, **more}


@pytest.fixture
def sides(tmp_path):
    source, target = Storage(str(tmp_path / "in")), Storage(str(tmp_path / "out"))

    def submission(path, files, contents, **more):
        source.write_text(f"{path}/desc.json", json.dumps({"version": "1", "files": files, **more}))
        for name, content in contents.items():
            source.write_bytes(f"{path}/{name}", content)

    submission("good", [doc("a.pdf", ".pdf"), doc("b.jpg", ".jpg")], {"a.pdf": b"PDF\none\ntwo", "b.jpg": b"pic"}, form_metadata={"legibility_score": 4}, user={"email": "A@b.c"})
    submission("deep/er/part", [doc("a.pdf", ".pdf"), doc("b.jpg", ".jpg"), doc("gone.jpg", ".jpg")], {"a.pdf": b"PDF\none\ntorn\nblind", "b.jpg": b"blob"})
    submission("broken", [doc("a.pdf", ".pdf")], {"a.pdf": b"junk"})
    submission("nullext", [doc("a.pdf", None)], {"a.pdf": b"PDF\none"})
    submission("empty", [], {})
    source.write_text("badjson/desc.json", "[")
    source.write_text("good/transforms.json", json.dumps({"a.pdf": {"2": [{"rotation": 90}]}}))
    return source, target, Settings(Side("local", str(tmp_path / "in")), Side("local", str(tmp_path / "out")), salt="s")


def manifest(spark, target):
    subs = {r["submission_id"]: (r["status"], r["error"]) for r in tables.load_submissions(spark, target).collect()}
    pages = {(r["submission_id"], r["doc_filename"], r["page_number"]): r for r in tables.load_pages(spark, target).collect()}
    return subs, pages


def test_normal_run_then_nothing_left_but_failures(spark, sides):
    source, target, settings = sides
    counts = runs.run(spark, settings, PROVIDERS)
    assert counts == {"submissions": 6, "completed": 3, "failed": 3, "pages": 10}
    subs, pages = manifest(spark, target)
    assert subs["good"] == subs["empty"] == ("completed", "")
    assert subs["part"] == ("completed", "Some pages failed: a.pdf, a_p3.jpg, b.jpg, gone.jpg")
    assert subs["broken"] == ("failed", "Failed to open PDF: no such format")
    assert subs["nullext"][0] == "failed" and subs["nullext"][1].startswith("Page extraction error: ")
    assert subs["badjson"] == ("failed", "Cannot parse desc.json: not a JSON object")
    assert pages["part", "a.pdf", 2]["error"] == "page is torn" and pages["part", "a.pdf", 3]["error"] == "Line extraction error: cannot see"
    assert pages["part", "gone.jpg", 1]["error"].startswith("Cannot read file: ") and pages["part", "b.jpg", 1]["error"] == "not an image"
    assert not any(k[0] == "nullext" for k in pages)
    two = pages["good", "a.pdf", 2]
    assert (two["image_filename"], two["lines_filename"], two["raw_image_filename"], two["raw_image_width"]) == ("a_p2.jpg", "a_p2.jpg.json", "a_p2.avif", 30)
    assert target.read_bytes("good/a_p2.jpg") == b"two@90"
    lines = json.loads(target.read_text("good/a_p2.jpg.json"))
    assert [x["index"] for x in lines["lines"]] == [0, 1] and lines["image_width"] == 15
    told = json.loads(target.read_text("good/metadata.json"))
    assert told["legibility_score"] == 4 and len(told["submitter_fingerprint"]) == 64
    assert json.loads(source.read_text("good/transforms.json"))["a.pdf"] == {"1": [{"rotation": None}], "2": [{"rotation": 90}]}
    assert not target.exists("nullext/metadata.json") and target.exists("empty/metadata.json")

    source.write_bytes("broken/a.pdf", b"PDF\nfixed")
    again = runs.run(spark, settings, PROVIDERS)
    assert again["submissions"] == 3 and again["completed"] == 1
    subs, later = manifest(spark, target)
    assert subs["broken"] == ("completed", "") and len(subs) == 6 and len(later) == len(pages)


def test_no_detector_fails_pages_only(spark, sides):
    _, target, settings = sides
    runs.run(spark, Settings(settings.source, settings.target, max_submissions=10), Providers(fakes.Pages, fakes.Images, fakes.no_detector))
    subs, pages = manifest(spark, target)
    assert subs["good"][0] == "failed" and pages["good", "b.jpg", 1]["image_filename"] == "b_p1.jpg"
    assert "weights are missing" in pages["good", "b.jpg", 1]["error"]


def test_metadata_run_leaves_manifests(spark, sides):
    _, target, settings = sides
    runs.run(spark, Settings(settings.source, settings.target, metadata_only=True), PROVIDERS)
    assert target.exists("good/metadata.json") and not target.exists("pages.csv")


def test_backfill(spark, sides):
    _, target, settings = sides
    runs.run(spark, settings, PROVIDERS)
    rows = tables.load_pages(spark, target).drop("_order").toPandas()
    rows.loc[rows.submission_id == "good", ["raw_image_filename", "raw_image_width", "raw_image_height"]] = ["", 0, 0]
    from pagewright.schema import PAGE

    tables.save_manifest(spark.createDataFrame(rows, PAGE), target, "pages.csv", ("submission_id", "doc_filename", "page_number"))
    back = Settings(settings.source, settings.target, backfill=True)
    before = target.read_bytes("submissions.csv")
    assert runs.run(spark, back, PROVIDERS) == {"pages": 3}
    _, pages = manifest(spark, target)
    assert pages["good", "a.pdf", 2]["raw_image_filename"] == "a_p2.avif" and len(pages) == len(rows)
    assert json.loads(target.read_text("good/a_p2.jpg.json"))["raw_image_width"] == 30
    assert target.read_bytes("submissions.csv") == before
    assert runs.run(spark, back, PROVIDERS) == {"pages": 0}
    assert not patch_lines(target, "good", "", {}) and not patch_lines(target, "good", "none.json", {})


def test_consumer_views(spark, sides):
    _, target, settings = sides
    runs.run(spark, settings, PROVIDERS)
    subs, pages = consumer.submissions(spark, target), consumer.pages(spark, target)
    lines = consumer.lines(pages, target)
    assert lines.count() == 2 * pages.filter("status = 'completed'").count()
    stats = {r["legibility_score"]: r["n"] for r in consumer.statistics(subs, "legibility_score").collect()}
    assert stats == {"4": 1, None: 5}
    averages = {r["name"]: r["score"] for r in consumer.statistics(spark.createDataFrame([('{"name": "a", "score": 1}',), ('{"name": "a", "score": "4"}',), ('{"name": "a", "score": "x"}',)], "metadata string"), "name", ("score",)).collect()}
    assert averages == {"a": 2.5}
    row = consumer.training_rows(subs, pages, lines).filter("submission_id = 'good' AND index = 1").first()
    assert row["raw_bbox"] == [2.0, 2.0, 18.0, 18.0]
    at = {(r["submission_id"], r["image_filename"]): r["index"] for r in consumer.line_at(lines, 7, 7).collect()}
    assert at["good", "a_p1.jpg"] == 1
    assert {r["index"] for r in consumer.line_at(lines, 70, 7).collect()} == {-1}


def test_settings_reach_the_providers(spark, tmp_path):
    """Thresholds, the largest side, rotations found anew by rotators in their order, with errors as no answer."""
    source, target = Storage(str(tmp_path / "in")), Storage(str(tmp_path / "out"))
    source.write_text("s/desc.json", json.dumps({"files": [doc("a.pdf", ".pdf")]}))
    source.write_bytes("s/a.pdf", b"PDF\nupside\nplain\nthin\ndim\nupside again")
    cache = {"a.pdf": {"1": [{"original_size": [9, 9]}, {"rotation": 90}], "2": [{"rotation": 270}], "5": [{"rotation": None}, {"rotation": 90}]}}
    source.write_text("s/transforms.json", json.dumps(cache))
    settings = Settings(Side("local", str(tmp_path / "in")), Side("local", str(tmp_path / "out")), text_threshold=0.7, blank_threshold=0.2, max_dimension=100, force_reprocess=True)
    runs.run(spark, settings, fakes.made_for(settings))
    _, pages = manifest(spark, target)
    assert [target.read_bytes(f"s/a_p{n}.jpg") for n in (1, 2, 5)] == [b"upside@90", b"plain@270", b"upside again@180"]
    assert pages["s", "a.pdf", 3]["error"] == "an image of 100 x 0 pixels"
    assert pages["s", "a.pdf", 4]["error"] == "Line extraction error: seen at 0.7 and 0.2"
    source.write_text("s/transforms.json", json.dumps(cache))
    runs.run(spark, replace(settings, redetect_rotation=True), fakes.made_for(settings))
    assert [target.read_bytes(f"s/a_p{n}.jpg") for n in (1, 2)] == [b"upside@180", b"plain@0"]
    assert json.loads(source.read_text("s/transforms.json"))["a.pdf"]["2"] == [{"rotation": None}]


def test_a_provider_or_storage_that_does_not_open_fails_submissions_without_pages(spark, sides, monkeypatch):
    source, target, settings = sides
    counts = runs.run(spark, settings, Providers(fakes.no_rasterizer, fakes.Images, fakes.Detector))
    subs, pages = manifest(spark, target)
    assert subs["good"] == ("failed", "Page extraction error: no such library") and not any(k[0] == "good" for k in pages)
    assert subs["empty"] == ("completed", "") and subs["badjson"][1].startswith("Cannot parse") and not target.exists("good/metadata.json")
    assert counts["failed"] == 5
    lost = Storage("nosuch://there")
    found = spark.createDataFrame([("a", "x/a")], "submission_id string, source_path string")
    row = runs.extract(found, lost, target, PROVIDERS, 1).first()
    assert row["broken"] and row["error"].startswith("Storage init error: ")


def test_command_line(spark, sides, monkeypatch, caplog):
    from pagewright.__main__ import main

    _, target, settings = sides
    env = {f"{side}_STORAGE_TYPE": "local" for side in ("SOURCE", "TARGET")} | {"SOURCE_STORAGE_PATH": settings.source.path, "TARGET_STORAGE_PATH": settings.target.path}
    assert main({}) == 1 and main(env) == 1 and main(env | {"PAGEWRIGHT_PROVIDERS": "tests.fakes:nothing"}) == 1
    assert main(env | {"PAGEWRIGHT_PROVIDERS": "tests.fakes:made_for"}) == 0
    assert manifest(spark, target)[0]["good"] == ("completed", "")


def test_a_stalled_run_publishes_only_what_has_ended(spark, sides):
    _, target, settings = sides
    with pytest.raises(incremental.Stalled):
        runs.run(spark, replace(settings, stall_warning=1, stall_timeout=2), Providers(Slow, fakes.Images, fakes.Detector))
    subs, pages = manifest(spark, target)
    assert subs.keys() == {"empty", "badjson", "nullext"} and {k[0] for k in pages} == {"badjson"}


class Slow(fakes.Pages):
    def __init__(self):
        time.sleep(60)


def test_consumer_tree(spark):
    subs = spark.createDataFrame([("bbbbbbbbbbbb", "failed"), ("aaaaaaaaaaaa", "completed"), ("c", "completed")], "submission_id string, status string")
    rows = [("aaaaaaaaaaaa", "y.pdf", "10"), ("aaaaaaaaaaaa", "y.pdf", "9"), ("aaaaaaaaaaaa", "x.pdf", "1"), ("zz", "q", "1"), ("bbbbbbbbbbbb", "d", "1")]
    pages = spark.createDataFrame([(*r, "i", "l") for r in rows], "submission_id string, doc_filename string, page_number string, image_filename string, lines_filename string")
    got = [(r["label"], r["doc_filename"], r["page_number"], r["document"], r["place"]) for r in consumer.tree(subs, pages).collect()]
    assert got == [
        ("[completed] aaaaaaaa...", "x.pdf", 1, 0, 0),
        ("[completed] aaaaaaaa...", "y.pdf", 9, 1, 0),
        ("[completed] aaaaaaaa...", "y.pdf", 10, 1, 1),
        ("[failed] bbbbbbbb...", "d", 1, 0, 0),
        ("[completed] c...", None, None, None, None),
    ]


def test_cached_rotation_is_taken_unless_redetected():
    assert cached_first([{"x": 1}, {"rotation": None}, {"rotation": 90}], False) is None
    assert cached_first([{"rotation": 180}], False) == 180 and cached_first([{"rotation": 180}], True) is None and cached_first(None, False) is None


def test_stream_processes_only_what_is_open(spark, sides, tmp_path):
    source, _, _ = sides
    done = spark.createDataFrame([("good", "completed")], "submission_id string, status string")
    seen = []
    query = incremental.follow(incremental.arriving(spark, source.base), lambda: done, lambda df: seen.extend(r[0] for r in df.select("submission_id").collect()), str(tmp_path / "check"))
    query.awaitTermination(120)
    assert sorted(seen) == ["badjson", "broken", "empty", "nullext", "part"]


def test_stalls_of_a_stream(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [("r", base + dt.timedelta(seconds=s)) for s in (0, 50, 200, 1200, 1210)]
    spark.createDataFrame(rows, "run_id string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "r"))
    stream = spark.readStream.schema("run_id string, ts timestamp").parquet(str(tmp_path / "r"))
    query = incremental.stalls(stream).writeStream.format("memory").queryName("stalls").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((r["gap"], r["aborts"]) for r in spark.table("stalls").collect()) == [(150, False), (1000, True)]


def test_a_timer_tells_stalls_while_nothing_comes(spark, tmp_path):
    folder = tmp_path / "r"
    spark.createDataFrame([("r",)], "run_id string").withColumn("ts", F.current_timestamp()).coalesce(1).write.parquet(str(folder))
    stream = spark.readStream.schema("run_id string, ts timestamp").parquet(str(folder))
    query = incremental.stalls(stream, 2, 6, timer=True).writeStream.format("memory").queryName("timed").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        for _ in range(90):
            rows = [(r["gap"], r["aborts"]) for r in spark.table("timed").collect()]
            if any(aborts for _, aborts in rows):
                break
            time.sleep(1)
    finally:
        query.stop()
    assert rows[-1][1] and rows[-1][0] >= 6 and len(rows) <= 2 and all(2 <= gap for gap, _ in rows)


def test_watch_ends_a_hanging_job(spark):
    warned = []

    def hang(batches):
        for b in batches:
            time.sleep(60)
            yield b

    with pytest.raises(incremental.Stalled):
        incremental.watched(spark, lambda: spark.range(4).mapInPandas(hang, "id long").count(), 8, 14, lambda s, stages: warned.append(stages), poll=0.5)
    assert len(warned) == 1 and any("tasks of" in s for s in warned[0])
    assert incremental.watched(spark, lambda: spark.range(10).filter(F.col("id") > 3).count(), None, None, poll=0.2) == 6
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
