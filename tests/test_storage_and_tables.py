"""Files, settings, manifests and descriptors."""

import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from pagewright.schema import PAGE, filled
from pagewright.settings import RotationService, Side, read_settings, whole_or
from pagewright.sources import descriptor, tables
from pagewright.sources.discovery import discover, repeated_ids
from pagewright.sources.storage import Storage, open_side, with_retry

ENV = {"SOURCE_STORAGE_TYPE": "local", "SOURCE_STORAGE_PATH": "/in", "TARGET_STORAGE_TYPE": "S3", "TARGET_STORAGE_PATH": "s3://b/p/"}


def test_settings_defaults_and_errors():
    s = read_settings(ENV)
    assert (s.parallelism, s.max_submissions, s.stall_warning, s.stall_timeout, s.target.kind) == (4, None, 90, 900, "s3")
    assert read_settings(ENV | {"WORKER_RESULT_TIMEOUT": "0"}).stall_timeout is None
    assert read_settings(ENV | {"FORCE_REPROCESS": " YES "}).force_reprocess
    assert read_settings(ENV | {"SUBMITTER_FINGERPRINT_SALT": " x "}).salt == " x "
    service = {"USE_IMAGE_TRANSFORM_AZURE_AI": "True", "AZURE_AI_ENDPOINT": "e", "AZURE_AI_API_KEY": "k", "MODEL_CACHE_DIR": "/m"}
    assert read_settings(ENV | service).rotation_service == RotationService("e", "k") and read_settings(ENV | service).model_cache == "/m"
    assert read_settings(ENV | service | {"AZURE_AI_API_KEY": ""}).rotation_service is None
    assert (whole_or(None, 9), whole_or(5, 9), whole_or("5", 9), whole_or(object(), 9)) == (None, 5, 9, 9)
    for bad in ({"WORKER_PARALLELISM": "four"}, {"WORKER_PARALLELISM": "0"}, {"MAX_SUBMISSIONS": "-1"}, {"DETECTOR_TEXT_THRESHOLD": "bad"}, {"SOURCE_STORAGE_TYPE": "ftp"}, {"SOURCE_STORAGE_PATH": "  "}, {"WORKER_RESULT_TIMEOUT": "x"}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            read_settings(ENV | bad)
    for name in ENV:
        with pytest.raises(ValueError, match=name):
            read_settings({k: v for k, v in ENV.items() if k != name})


def test_open_side():
    assert open_side(Side("s3", "s3://b/p/q/"))[1] == "p/q"
    assert open_side(Side("local", "/x"))[1] == ""
    with pytest.raises(ValueError):
        open_side(Side("s3", "/x"))


def test_storage(tmp_path):
    s = Storage(str(tmp_path))
    for p in ("a/desc.json", "a/b/c/desc.json", "_h/desc.json", ".d/desc.json", "a/xdesc.json", "a/desc.json.bak", "z.txt"):
        s.write_text(p, p)
    assert s.walk("", "desc.json") == [".d/desc.json", "_h/desc.json", "a/b/c/desc.json", "a/desc.json"]
    assert s.walk("a/b", "desc.json") == ["a/b/c/desc.json"]
    assert s.list_prefixes("") == [".d/", "_h/", "a/"] and s.list_files("") == ["z.txt"] and s.list_prefixes("no") == []
    assert s.exists("a") and s.exists("a/desc.json") and not s.exists("nope") and not s.exists("../x")
    with pytest.raises(ValueError):
        s.read_bytes("../../etc/passwd")
    s.delete("z.txt")
    s.delete("z.txt")
    assert not s.exists("z.txt")
    s.probe_read()
    s.probe_write()


def test_addresses_for_spark_keep_their_scheme(spark, tmp_path):
    bucket, prefix = open_side(Side("s3", "s3://box/p/q/", "id", "hush", "eu"))
    assert bucket.uri(f"{prefix}/pages.csv") == "s3a://box/p/q/pages.csv"
    assert bucket.hadoop_settings() == {"fs.s3a.bucket.box.access.key": "id", "fs.s3a.bucket.box.secret.key": "hush", "fs.s3a.bucket.box.endpoint.region": "eu"}
    bucket.prepare(spark)
    assert spark.sparkContext._jsc.hadoopConfiguration().get("fs.s3a.bucket.box.access.key") == "id"
    for s in (Storage(str(tmp_path)), Storage(f"file://{tmp_path}")):
        assert s.uri("a/b") == f"file://{tmp_path}/a/b" and s.hadoop_settings() == {}
        s.write_text("submissions.csv", "submission_id,status\na,failed\n")
        assert tables.load_submissions(spark, s).first()["status"] == "failed"
        with pytest.raises(ValueError):
            s.uri("../x")


def test_retry_uses_all_attempts():
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        with_retry(fails, sleep=waits.append)
    assert len(calls) == 3 and waits == [0.5, 1.0]
    assert with_retry(lambda: 7) == 7


def test_discovery(spark, tmp_path):
    s = Storage(str(tmp_path))
    for p in ("desc.json", "s1/desc.json", "x/s2/desc.json", "x/y/z/s3/desc.json", "_k/s4/desc.json", "x/s1/desc.json", "x/other.json"):
        s.write_text(p, "{}")
    got = sorted(tuple(r) for r in discover(spark, s).collect())
    assert got == [("s1", "s1"), ("s1", "x/s1"), ("s2", "x/s2"), ("s3", "x/y/z/s3"), ("s4", "_k/s4")]
    assert [r["submission_id"] for r in repeated_ids(discover(spark, s)).collect()] == ["s1"]
    assert discover(spark, Storage(str(tmp_path / "none"))).count() == 0


ERRORS = ["a,b", 'say "x"', "two\nlines", "cr\rhere", "  padded ", "back\\slash", '"', "#", "null", "é ñ", "", "end\\"]


def test_csv_round_trip_is_that_of_python(spark, tmp_path):
    s = Storage(str(tmp_path))
    rows = [("s", f"d{k}", k, "failed", e, "", "", "", 0, 0) for k, e in enumerate(ERRORS)]
    df = spark.createDataFrame(rows, PAGE)
    tables.save_manifest(df, s, "pages.csv", ("submission_id", "doc_filename", "page_number"))
    with open(tmp_path / "pages.csv", newline="", encoding="utf-8") as f:
        assert sorted(r["error"] for r in csv.DictReader(f)) == sorted(ERRORS)
    written = io.StringIO()
    csv.writer(written, lineterminator="\n").writerows([df.columns, *sorted(rows, key=lambda r: r[:3])])
    assert (tmp_path / "pages.csv").read_bytes() == written.getvalue().encode()
    assert [p.name for p in tmp_path.iterdir() if "csv" in p.name and not p.name.startswith(".")] == ["pages.csv"]
    back = tables.load_pages(spark, s).drop("_order")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_reads_by_name_and_fills_old_files(spark, tmp_path):
    s = Storage(str(tmp_path))
    s.write_text("pages.csv", "page_number,status,submission_id,doc_filename,raw_image_width\n42,completed,a,d,\n1,failed,b,d,7\n")
    got = sorted((r["submission_id"], r["page_number"], r["raw_image_width"], r["error"]) for r in tables.load_pages(spark, s).collect())
    assert got == [("a", 42, 0, ""), ("b", 1, 7, "")]
    s.write_text("submissions.csv", "submission_id,status,error\na,failed,x\nb,completed,\na,completed,\n")
    assert sorted(map(tuple, tables.load_submissions(spark, s).collect())) == [("a", "completed", ""), ("b", "completed", "")]
    assert tables.load_pages(spark, s, "nowhere").count() == 0
    s.write_text("bad/pages.csv", "submission_id,status\na,completed\n")
    with pytest.raises(KeyError):
        tables.load_pages(spark, s, "bad")
    tables.save_manifest(filled(spark.createDataFrame([], PAGE), PAGE), s, "empty.csv", ("submission_id",))
    assert s.read_text("empty.csv").startswith("submission_id,doc_filename,page_number")


def test_descriptors(spark):
    texts = [
        ("a", json.dumps({"version": "1", "user": {"email": "x@y.z"}, "files": [{"stored_filename": "1.pdf", "file_extension": ".pdf", "mime_type": None, "size": 3}, {"stored_filename": "2"}]})),
        ("b", "[1, 2]"),
        ("c", "{broken"),
        ("d", json.dumps({"user": "u1", "files": [{"stored_filename": "q", "file_extension": None}]})),
    ]
    rows = spark.createDataFrame([(i, i, bytearray(t.encode()), "") for i, t in texts] + [("e", "e", None, "gone")], "submission_id string, source_path string, content binary, error string")
    parsed = descriptor.parsed(rows)
    got = {r["submission_id"]: r for r in parsed.collect()}
    assert [got[i]["stage"] for i in "abcde"] == ["", "parse", "parse", "", "descriptor"]
    assert got["a"]["user_email"] == "x@y.z" and got["d"]["user_email"] is None and got["d"]["user"] == "u1"
    docs = {(r["submission_id"], r["position"]): r for r in descriptor.documents(parsed).collect()}
    assert docs["a", 0]["extra"] == {"size": "3"} and docs["a", 1]["file_extension"] == "" and docs["d", 0]["file_extension"] is None


def test_metadata_keeps_what_it_may():
    of = lambda d: descriptor.metadata_of(json.dumps(d), "s")
    assert json.loads(of({"form_metadata": {"b": 1, "a": 1.0}})) == {"b": 1, "a": 1.0}
    assert "1.0" in of({"form_metadata": {"a": 1.0}})
    assert list(json.loads(of({"form_metadata": {"z": 1}, "user": {"email": " A@b "}}))) == ["z", "submitter_fingerprint"]
    assert of({"form_metadata": None}) == "null" and of({"form_metadata": None, "user": {"email": "x"}}) is None
    assert of({}) == "{}" and descriptor.metadata_of("[", "s") is None


def test_rotations(spark):
    caches = spark.createDataFrame([("a", json.dumps({"d": {"1": [{"rotation": 90}], "2": [{"original_size": [1, 2]}], "3": [{"original_size": [1, 2]}, {"rotation": None}, {"rotation": 90}]}})), ("b", "no json")], "submission_id string, text string")
    from pagewright.functions.exprs import cached_rotation

    got = {(r["doc_filename"], r["page_number"]): r["r"] for r in descriptor.rotations(caches).select("doc_filename", "page_number", cached_rotation(F.col("applied")).alias("r")).collect()}
    assert got == {("d", 1): 90, ("d", 2): None, ("d", 3): None}
