"""Hand-made documents: tables and streams of references, updates, inherited resources, damage."""

import json
import re
import zlib

import numpy as np
import pytest

from pagewright.operators import pixels as X
from pagewright.operators.imaging import Providers
from pagewright.operators.pdf import Document, PdfPages, ScannedPdf
from pagewright.plans import runs
from pagewright.settings import Settings, Side
from pagewright.sources import tables
from pagewright.sources.storage import Storage
from tests.test_pixels import page as drawn
from tests.test_runs import doc

JPEG = b"\xff\xd8 a scan \xff\xd9"


def stream(told, data):
    return b"<< %s /Length %d >>\nstream\n%s\nendstream" % (told, len(data), data)


def image(pixels, filters=b"/Filter /FlateDecode", data=None, space=b"/DeviceRGB"):
    h, w = pixels.shape[:2]
    return stream(b"/Type /XObject /Subtype /Image /Width %d /Height %d /BitsPerComponent 8 /ColorSpace %s %s" % (w, h, space, filters), zlib.compress(pixels.tobytes()) if data is None else data)


def written(objects, head=b"%PDF-1.4\n", extra=b"", previous=None):
    """A document with a table of references; with ``previous`` an update of that."""
    out, places = previous or head, {}
    for k, body in objects.items():
        places[k] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (k, body)
    at = len(out)
    out += b"xref\n" + b"".join(b"%d 1\n%010d 00000 n \n" % (k, p) for k, p in places.items())
    prev = b"/Prev %s" % re.findall(rb"startxref\s+(\d+)", previous)[-1] if previous else b""
    return out + b"trailer\n<< /Size 99 /Root 1 0 R %s %s >>\nstartxref\n%d\n%%%%EOF" % (prev, extra, at)


RGB = drawn(160, 60, 1)[0]


def scans():
    """Three pages in a tree of two levels: a scan of its own, one of inherited resources, and drawn text."""
    return {
        1: b"<< /Type /Catalog /Pages 2 0 R /Text (a \\) ( b ) > ) >>",
        2: b"<< /Type /Pages /Kids [3 0 R 6 0 R] /Count 3 /Resources << /XObject << /A 8 0 R >> >> >>",
        3: b"<< /Type /Pages /Kids [4 0 R 5 0 R] /Count 2 >> % a remark",
        4: b"<< /Type /Page /Resources << /XObject << /B 9 0 R /S 10 0 R >> >> >>",
        5: b"<< /Type /Page >>",
        6: b"<< /Type /Page /Resources << /Font << /F 7 0 R >> >> /Name <41 4> >>",
        7: b"<< /Type /Font >>",
        8: image(RGB),
        9: image(np.zeros((500, 400, 3), np.uint8), b"/Filter /DCTDecode", JPEG),
        10: image(RGB[:2, :2]),
    }


def packed(objects):
    """The same with all but streams in a stream of objects, and a stream of references with a predictor."""
    plain = {k: v for k, v in objects.items() if b"stream" not in v}
    heads, body = b"", b""
    for k, v in plain.items():
        heads += b"%d %d " % (k, len(body))
        body += v.split(b"%")[0] + b" "
    out, places = b"%PDF-1.5\n", {}
    others = {k: v for k, v in objects.items() if k not in plain} | {50: stream(b"/Type /ObjStm /N %d /First %d /Filter /FlateDecode" % (len(plain), len(heads)), zlib.compress(heads + body))}
    for k, v in others.items():
        places[k] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (k, v)
    rows = [(2, 50, i) if k in plain and (i := list(plain).index(k)) >= 0 else (1, places[k], 0) if k in places else (0, 0, 0) for k in range(51)]
    raw = np.array([[a, *b.to_bytes(3), c] for a, b, c in rows], np.uint8)
    up = np.concatenate([np.full((len(raw), 1), 2, np.uint8), np.diff(raw, axis=0, prepend=0).astype(np.uint8)], axis=1)
    told = b"/Type /XRef /Size 51 /W [1 3 1] /Root 1 0 R /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 5 >>"
    return out + b"60 0 obj\n%s\nendobj\nstartxref\n%d\n%%%%EOF" % (stream(told, zlib.compress(up.tobytes())), len(out))


@pytest.mark.parametrize("make", [written, packed])
def test_pages_in_order(make):
    one, two, three = ScannedPdf().pages(make(scans()))
    assert one == JPEG and (X.read_png(two)[0] == RGB).all() and str(three) == "the page has no scan"


def test_damaged_references_are_looked_for():
    whole = written(scans())
    for torn in (re.sub(rb"startxref\n\d+", b"startxref\n7", whole), whole[: whole.index(b"xref\n0") if b"xref\n0" in whole else whole.index(b"xref\n")], re.sub(rb"\d{10} 00000 n", b"0000000003 00000 n", whole)):
        if b"trailer" not in torn:
            torn += b"% no trailer"
        got = list(ScannedPdf().pages(torn))
        assert got[0] == JPEG and (X.read_png(got[1])[0] == RGB).all() and len(got) == 3


def test_an_update_counts():
    new = written({5: b"<< /Type /Page /Resources << /XObject << /A 11 0 R >> >> >>", 11: image(RGB[::-1])}, previous=written(scans()))
    assert (X.read_png(list(ScannedPdf().pages(new))[1])[0] == RGB[::-1]).all()


def test_kinds_of_scans():
    grey = RGB[..., 0].copy()
    filtered = np.concatenate([np.ones((len(RGB), 1), np.uint8), np.diff(RGB.reshape(len(RGB), -1, 3), axis=1, prepend=0).astype(np.uint8).reshape(len(RGB), -1)], axis=1)
    kinds = {
        "grey": image(grey, space=b"/DeviceGray"),
        "filtered": image(RGB, b"/Filter [/FlateDecode] /DecodeParms [<< /Predictor 15 /Colors 3 /Columns %d >>]" % RGB.shape[1], zlib.compress(filtered.tobytes())),
        "twice": image(RGB, b"/Filter [/FlateDecode /DCTDecode]", zlib.compress(JPEG)),
        "bits": image(RGB, b"/Filter /CCITTFaxDecode", b"x"),
        "short": image(RGB, data=zlib.compress(b"abc")),
    }
    got = {}
    for name, body in kinds.items():
        got[name] = next(ScannedPdf().pages(written(scans() | {9: body, 10: b"null"})))
    assert (X.read_png(got["grey"])[0] == np.repeat(grey[..., None], 3, axis=2)).all() and (X.read_png(got["filtered"])[0] == RGB).all() and got["twice"] == JPEG
    assert "CCITTFaxDecode" in str(got["bits"]) and isinstance(got["short"], ValueError)


@pytest.mark.parametrize("content", [b"", b"not a pdf at all", b"%PDF-1.4", b"%PDF-1.4\n" + bytes(range(256)) * 40, written({1: b"<< /Type /Catalog >>"}), written(scans(), extra=b"/Encrypt << >>"), written(scans() | {2: b"2 0 R"})])
def test_what_does_not_open(content):
    with pytest.raises(ValueError, match="."):
        Document(content)


def test_trees_in_a_circle_end():
    with pytest.raises(ValueError, match="damaged"):
        list(Document(written(scans() | {3: b"<< /Kids [2 0 R] >>"})).pages())


def test_rows_of_pages(spark):
    spark.udtf.register("pdf_pages", PdfPages)
    docs = spark.createDataFrame([(1, written(scans())), (2, b"junk"), (3, None), (4, packed(scans()))], "id int, content binary")
    docs.createOrReplaceTempView("pdf_docs")
    got = [(r["id"], r["page_number"], r["image"] is not None, r["error"]) for r in spark.sql("SELECT id, p.* FROM pdf_docs, LATERAL pdf_pages(content) p ORDER BY id, page_number").collect()]
    each = [(1, True, None), (2, True, None), (3, False, "the page has no scan")]
    assert got == [*((1, *e) for e in each), (2, 0, False, "not a PDF document"), *((4, *e) for e in each)]


def test_a_whole_run_over_scans(spark, tmp_path):
    source, target = Storage(str(tmp_path / "in")), Storage(str(tmp_path / "out"))
    pixels, boxes = drawn(300, 220, 5)
    objects = scans() | {9: image(np.rot90(pixels, -1)), 10: b"null"}
    source.write_text("s/desc.json", json.dumps({"files": [doc("x.pdf", ".pdf"), doc("y.pdf", ".pdf")]}))
    source.write_bytes("s/x.pdf", packed(objects))
    source.write_bytes("s/y.pdf", b"not a pdf at all")
    settings = Settings(Side("local", str(tmp_path / "in")), Side("local", str(tmp_path / "out")))
    assert runs.run(spark, settings, Providers(ScannedPdf, X.PngImages, X.RunLengthDetector, (X.quarter_turn,)))["pages"] == 4
    pages = {(r["doc_filename"], r["page_number"]): r for r in tables.load_pages(spark, target).collect()}
    first = pages["x.pdf", 1]
    assert first["status"] == "completed" and (X.read_png(target.read_bytes(f"s/{first['image_filename']}"))[0] == pixels).all()
    assert [x["bbox"] for x in json.loads(target.read_text(f"s/{first['lines_filename']}"))["lines"]] == boxes
    assert pages["x.pdf", 3]["error"] == "the page has no scan" and pages["y.pdf", 1]["error"] == "Failed to open PDF: not a PDF document"
