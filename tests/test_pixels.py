"""Real images through the providers that need no library, and through a whole run."""

import json
import struct
import zlib

import numpy as np
import pytest

from pagewright.operators import pixels as X
from pagewright.operators.imaging import Options, Providers
from pagewright.plans import runs
from pagewright.settings import Settings, Side
from pagewright.sources import tables
from pagewright.sources.storage import Storage
from tests.test_runs import doc

PNG = Providers(X.NoDocuments, X.PngImages, X.RunLengthDetector, (X.quarter_turn,))


def page(width=300, height=220, seed=0):
    """A page with lines of words of unequal lengths that begin at one margin, and the boxes of those lines."""
    rnd, out, boxes = np.random.default_rng(seed), np.full((height, width, 3), 255, np.uint8), []
    for y in range(20, height - 25, 22):
        x, end = 20, int(rnd.integers(90, width - 30))
        while x < end:
            wide = int(rnd.integers(8, 26))
            out[y : y + 9, x : x + wide] = rnd.integers(0, 60)
            last, x = x + wide, x + wide + 5
        boxes.append([20.0, float(y), float(last), float(y + 9)])
    return out, boxes


def encoded(pixels, colour, filters):
    """A PNG of any colour type, with the filters in turn, by the definition of each."""
    h, w, n = pixels.shape
    rows, above = b"", np.zeros(w * n, int)
    for k in range(h):
        row, kind = pixels[k].reshape(-1).astype(int), filters[k % len(filters)]
        left, corner = np.concatenate([np.zeros(n, int), row[:-n]]), np.concatenate([np.zeros(n, int), above[:-n]])
        p = left + above - corner
        d = np.abs(np.stack([p - left, p - above, p - corner]))
        paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], above, corner))
        guess = [np.zeros_like(row), left, above, (left + above) // 2, paeth][kind]
        rows, above = rows + bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes(), row

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


@pytest.mark.parametrize(("colour", "samples"), [(0, 1), (2, 3), (4, 2), (6, 4)])
def test_all_filters_and_colours(colour, samples):
    image = np.random.default_rng(1).integers(0, 256, (23, 17, samples)).astype(np.uint8)
    got, exif = X.read_png(encoded(image, colour, [0, 1, 2, 3, 4, 4, 3]))
    want = image[..., : samples - (samples in (2, 4))].astype(int)
    if samples in (2, 4):
        seen = image[..., -1:].astype(int)
        want = np.rint((want * seen + 255 * (255 - seen)) / 255).astype(int)
    assert exif == b"" and (np.abs(got - np.broadcast_to(want, got.shape)) <= (samples in (2, 4))).all()
    assert (X.read_png(X.write_png(got, b"II*\0"))[0] == got).all() and X.read_png(X.write_png(got, b"II*\0"))[1] == b"II*\0"


@pytest.mark.parametrize("content", [b"", b"binary blob", b"\x89PNG\r\n\x1a\n", b"\x89PNG\r\n\x1a\n" + b"\0" * 40, bytes(range(256)) * 1000])
def test_what_is_no_image(content):
    with pytest.raises(ValueError, match="."):
        X.read_png(content)
    done = X.PngImages().transform(content, 90, lambda _: 1 / 0, Options())
    assert (done.image, done.raw, done.applied) == (content, None, {"rotation": 90})


def test_exif_orientations():
    image = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    for order in "<>":
        for told in range(1, 9):
            exif = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HIH", 42, 8, 2) + struct.pack(f"{order}HHII", 0x010F, 2, 1, 0) + struct.pack(f"{order}HHIHH", 0x0112, 3, 1, told, 0)
            assert X.orientation(exif) == X.orientation(b"Exif\0\0" + exif) == told
    # where each orientation's stored pixels go, by row and column
    h, w = image.shape[:2]
    goes = {1: lambda r, c: (r, c), 2: lambda r, c: (r, w - 1 - c), 3: lambda r, c: (h - 1 - r, w - 1 - c), 4: lambda r, c: (h - 1 - r, c)}
    goes |= {5: lambda r, c: (c, r), 6: lambda r, c: (c, h - 1 - r), 7: lambda r, c: (w - 1 - c, h - 1 - r), 8: lambda r, c: (w - 1 - c, r)}
    for told, to in goes.items():
        seen = X.upright(image, told)
        assert all((seen[to(r, c)] == image[r, c]).all() for r in range(h) for c in range(w))
    assert [X.orientation(x) for x in (b"", b"II", b"II*\0\xff\xff\xff\xff", b"junk" * 9)] == [1] * 4


@pytest.mark.parametrize(("width", "height", "most", "to"), [(400, 200, 100, (100, 50)), (200, 500, 100, (40, 100)), (300, 300, 100, (100, 100)), (90, 80, 100, (90, 80)), (100, 100, 100, (100, 100)), (333, 101, 100, (100, 30))])
def test_sizes_of_published_images(width, height, most, to):
    red = np.zeros((height, width, 3), np.uint8) + np.array([255, 0, 0], np.uint8)
    done = X.PngImages().transform(X.write_png(red), 0, None, Options(max_dimension=most))
    got, raw = X.read_png(done.image)[0], X.read_png(done.raw)[0]
    assert (got.shape[1], got.shape[0]) == to and (got == [255, 0, 0]).all() and raw.shape == red.shape
    assert (done.raw_width, done.raw_height) == (width, height)
    assert done.applied == ({"rotation": 0} if to == (width, height) else {"rotation": 0, "original_size": [width, height]})
    with pytest.raises(ValueError, match="pixels"):
        X.PngImages().transform(X.write_png(red[:1]), 0, None, Options(max_dimension=1))


def test_areas_are_averaged():
    image = np.random.default_rng(2).integers(0, 256, (12, 18, 3)).astype(np.uint8)
    want = np.rint(image.reshape(4, 3, 9, 2, 3).mean(axis=(1, 3)))
    assert (np.abs(X.reduced(image, 9, 4) - want) <= 1).all()
    odd = X.reduced(image, 7, 5)
    assert odd.shape == (5, 7, 3) and abs(odd.mean() - image.mean()) < 1


@pytest.mark.parametrize("seed", range(6))
def test_turned_pages_are_told(seed):
    image, _ = page(300 + 40 * seed, 260, seed)
    for turn in (0, 90, 180, 270):  # clockwise
        assert X.quarter_turn(X.write_png(np.rot90(image, -turn // 90))) == -turn % 360
    assert X.quarter_turn(X.write_png(np.full((50, 60, 3), 255, np.uint8))) is None
    assert X.quarter_turn(X.write_png(np.random.default_rng(seed).integers(0, 256, (60, 60, 3)).astype(np.uint8))) is None


def test_lines_and_thresholds():
    image, boxes = page()
    found = X.RunLengthDetector(Options()).detect(X.write_png(image))
    assert [x["bbox"] for x in found] == boxes and all(x["polygon"][2] == x["bbox"][2:] and 0.7 < x["confidence"] <= 1 for x in found)
    pale = np.full((60, 200, 3), 255, np.uint8)
    pale[10:18, 10:150], pale[30:38, 10:150], pale[31:33, 20:30] = 128, 140, 60
    count = lambda **t: len(X.RunLengthDetector(Options(**t)).detect(X.write_png(pale)))
    assert (count(), count(text_threshold=0.4), count(text_threshold=0.4, blank_threshold=0.48), count(text_threshold=0.9)) == (1, 2, 2, 0)
    assert X.RunLengthDetector(Options(blank_threshold=0.48)).detect(X.write_png(pale))[0]["bbox"] == [20.0, 31.0, 30.0, 33.0]
    assert count(blank_threshold=0.99) == 0


def test_a_whole_run_over_real_images(spark, tmp_path):
    """Turned and large pages come out upright and small, with their lines; what is no image fails alone."""
    source, target = Storage(str(tmp_path / "in")), Storage(str(tmp_path / "out"))
    image, boxes = page(600, 440, 3)
    names = {"up.png": 0, "side.png": 90, "down.png": 180, "left.png": 270}
    source.write_text("s/desc.json", json.dumps({"files": [doc(n, ".png") for n in [*names, "blob.png"]] + [doc("x.pdf", ".pdf")]}))
    for name, turn in names.items():
        source.write_bytes(f"s/{name}", X.write_png(np.rot90(image, -turn // 90)))
    source.write_bytes("s/blob.png", b"no image")
    source.write_bytes("s/x.pdf", b"%PDF-1.4")
    settings = Settings(Side("local", str(tmp_path / "in")), Side("local", str(tmp_path / "out")), max_dimension=300)
    assert runs.run(spark, settings, PNG) == {"submissions": 1, "completed": 1, "failed": 0, "pages": 6}
    pages = {r["doc_filename"]: r for r in tables.load_pages(spark, target).collect()}
    for name, turn in names.items():
        own = pages[name]
        assert own["status"] == "completed" and (own["raw_image_width"], own["raw_image_height"]) == (600, 440)
        assert (X.read_png(target.read_bytes(f"s/{own['raw_image_filename']}"))[0] == image).all()
        lines = json.loads(target.read_text(f"s/{own['lines_filename']}"))
        assert (lines["image_width"], lines["image_height"]) == (300, 220) and len(lines["lines"]) == len(boxes)
        assert all(abs(2 * a - b) <= 2 for x, want in zip(lines["lines"], boxes) for a, b in zip(x["bbox"], want))
        told = json.loads(source.read_text("s/transforms.json"))[name]["1"][0]
        assert told["rotation"] == -turn % 360 and sorted(told["original_size"]) == [440, 600]
    assert pages["blob.png"]["error"] == "not a PNG image" and pages["x.pdf"]["error"].startswith("Failed to open PDF: ")
