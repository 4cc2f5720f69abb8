"""Pages and lines of documents, by providers that bring the image libraries.

The work runs in mapInPandas over few documents at a time. Whatever a provider
raises becomes the row of the page or document it happened to.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import DataFrame

from pagewright.operators.outcomes import NO_IMAGE, STAGES
from pagewright.schema import COMPLETED, FAILED, PENDING
from pagewright.sources.journal import Journal
from pagewright.sources.storage import Storage


@dataclass
class Transformed:
    """An image as published, the raw one (or none) with its size, and what was done to it."""

    image: bytes
    raw: bytes | None
    raw_width: int
    raw_height: int
    applied: dict[str, Any]


class Rasterizer(Protocol):
    def pages(self, content: bytes) -> Iterable[bytes | Exception]:
        """JPEG of each page in turn, or what went wrong with it; raises if the document does not open."""


#: Degrees clockwise that turn an image upright, or None where that cannot be told.
Rotator = Callable[[bytes], "int | None"]


@dataclass(frozen=True)
class Options:
    """What a run's settings ask of the providers."""

    max_dimension: int = 1024
    text_threshold: float | None = None
    blank_threshold: float | None = None
    redetect_rotation: bool = False


class Images(Protocol):
    def to_jpeg(self, content: bytes) -> bytes:
        """Any image as RGB JPEG with its EXIF."""

    def transform(self, image: bytes, rotation: int | None, find: Rotator, options: Options) -> Transformed:
        """Made smaller (see target_size), then turned by ``rotation``, or where that is None by what ``find`` says of the smaller image; the raw image, as large as it was and turned alike, beside it. Bytes that are no image come back as they are."""

    def size(self, image: bytes) -> tuple[int, int]:
        """Width and height."""


def extensions(images: Images) -> tuple[str, str]:
    """What names of published and raw images end with; a provider of other formats says so itself."""
    return getattr(images, "extension", "jpg"), getattr(images, "raw_extension", "avif")


class Detector(Protocol):
    def detect(self, image: bytes) -> list[dict[str, Any]]:
        """Lines with bbox, polygon and confidence (or None), in reading order."""


@dataclass(frozen=True)
class Providers:
    """Factories, so that each Python worker makes its own once; a model is loaded where it is used.

    The detector's factory gets the options. ``rotators`` are tried in their order.
    """

    rasterizer: Any
    images: Any
    detector: Any
    rotators: tuple[Rotator, ...] = ()
    options: Options = Options()

    def made(self) -> _Made:
        key = (self.rasterizer, self.images, self.detector, self.rotators, self.options)
        if key not in _MADE:
            try:
                detector, problem = self.detector(self.options), None
            except Exception as error:  # pages then fail one by one
                detector, problem = None, error
            _MADE[key] = _Made(self.rasterizer(), self.images(), detector, problem, self.rotators, self.options)
        return _MADE[key]


def first_rotation(rotators: tuple[Rotator, ...]) -> Rotator:
    """The first answer that is not None; a rotator that raises has none."""

    def find(image: bytes) -> int | None:
        for rotator in rotators:
            try:
                answer = rotator(image)
            except Exception:
                answer = None
            if answer is not None:
                return answer
        return None

    return find


def target_size(width: int, height: int, most: int) -> tuple[int, int]:
    """The size of a published image: the longer side at most ``most``, halves to even; ValueError where a side would vanish."""
    if width > most or height > most:
        width, height = (most, round(height * most / width)) if width > height else (round(width * most / height), most)
    if width < 1 or height < 1:
        raise ValueError(f"an image of {width} x {height} pixels")
    return width, height


@dataclass
class _Made:
    rasterizer: Rasterizer
    images: Images
    detector: Detector | None
    problem: Exception | None
    rotators: tuple[Rotator, ...] = ()
    options: Options = Options()

    def transformed(self, image: bytes, cached: list[dict[str, Any]] | None, redetect: bool | None = None) -> Transformed:
        redo = self.options.redetect_rotation if redetect is None else redetect
        return self.images.transform(image, cached_first(cached, redo), first_rotation(self.rotators), self.options)


_MADE: dict[tuple, _Made] = {}

PAGES = (
    "submission_id string, doc_filename string, position int, page_number int, status string, error string, image_filename string, lines_filename string,"
    " raw_image_filename string, raw_image_width int, raw_image_height int, applied string, image binary, broken boolean"
)
#: The type of a page in a journal.
RECORDED = f"struct<{PAGES.replace(', image binary', '')}>"


def cached_first(applied: list[dict[str, Any]] | None, redetect: bool) -> int | None:
    """The rotation that an earlier run found, unless it is to be found anew."""
    if redetect:
        return None
    return next((t["rotation"] for t in applied or [] if "rotation" in t), None)


def stem(name: str) -> str:
    base = name.rsplit("/", 1)[-1]
    at = base.rfind(".")
    return base[:at] if 0 < at < len(base) - 1 else base


def _row(doc: dict[str, Any], page: int, **more: Any) -> dict[str, Any]:
    empty = {"status": FAILED, "error": "", "image_filename": "", "lines_filename": "", "raw_image_filename": "", "raw_image_width": 0, "raw_image_height": 0, "applied": None, "image": None, "broken": False}
    return {"submission_id": doc["submission_id"], "doc_filename": doc["doc_filename"], "position": doc["position"], "page_number": page, **empty, **more}


def _page(doc: dict[str, Any], page: int, jpeg: bytes, made: _Made, target: Storage, cached: list | None) -> dict[str, Any]:
    done = made.transformed(jpeg, cached)
    ending, raw_ending = extensions(made.images)
    name, raw_name = f"{stem(doc['doc_filename'])}_p{page}.{ending}", ""
    target.write_bytes(f"{doc['submission_id']}/{name}", done.image)
    if done.raw is not None:
        raw_name = f"{stem(doc['doc_filename'])}_p{page}.{raw_ending}"
        target.write_bytes(f"{doc['submission_id']}/{raw_name}", done.raw)
    sizes = {"raw_image_width": done.raw_width, "raw_image_height": done.raw_height} if raw_name else {}
    return _row(doc, page, status=PENDING, image_filename=name, raw_image_filename=raw_name, applied=json.dumps(done.applied), image=done.image, **sizes)


def _value(text: str | None) -> Any:
    try:
        return None if text is None else json.loads(text)
    except ValueError:  # a string comes without its quotes
        return text


def pages_of(doc: dict[str, Any], made: _Made, target: Storage) -> Iterator[dict[str, Any]]:
    """Rows of one document (content, error, pdf and cached are among its fields)."""
    if doc["error"]:
        yield _row(doc, 1, error=STAGES["read"] + doc["error"])
        return
    cache = {page: [{k: _value(v) for k, v in t.items()} for t in done] for page, done in json.loads(doc.get("cached") or "{}").items()}
    if not doc["pdf"]:
        try:
            yield _page(doc, 1, made.images.to_jpeg(doc["content"]), made, target, cache.get("1"))
        except Exception as problem:
            yield _row(doc, 1, error=str(problem))
        return
    try:
        pages = iter(made.rasterizer.pages(doc["content"]))
    except Exception as problem:
        yield _row(doc, 1, error=STAGES["open"] + str(problem))
        return
    number = 0
    while True:
        try:
            jpeg = next(pages)
        except StopIteration:
            return
        except Exception as problem:  # a provider that opens only when it is asked for a page
            yield _row(doc, number + 1, error=(STAGES["open"] if number == 0 else "") + str(problem))
            return
        number += 1
        try:
            if isinstance(jpeg, Exception):
                raise jpeg
            yield _page(doc, number, jpeg, made, target, cache.get(str(number)))
        except Exception as problem:
            yield _row(doc, number, error=str(problem))


def with_lines(page: dict[str, Any], made: _Made, target: Storage) -> dict[str, Any]:
    """The page with its lines detected and written; pages that have failed already stay as they are."""
    if page["status"] != PENDING:
        return page
    if not page["image_filename"]:
        return {**page, "status": FAILED, "error": NO_IMAGE}
    place = f"{page['submission_id']}/{page['image_filename']}"
    try:
        image = page["image"] if page["image"] is not None else target.read_bytes(place)
    except Exception as problem:
        return {**page, "status": FAILED, "error": f"Cannot read image from target storage ({place}): {problem}", "lines_filename": ""}
    try:
        if made.detector is None:
            raise RuntimeError(f"no detector: {made.problem}")
        found = made.detector.detect(image)
        width, height = made.images.size(image)
    except Exception as problem:
        return {**page, "status": FAILED, "error": STAGES["lines"] + str(problem), "lines_filename": ""}
    name = page["image_filename"].rsplit("/", 1)[-1] + ".json"
    own = ("raw_image_filename", "raw_image_width", "raw_image_height")
    payload = {"submission_id": page["submission_id"], "image_filename": page["image_filename"], "image_width": width, "image_height": height}
    payload |= {k: page[k] for k in own} | {"lines": [{"index": k, **line} for k, line in enumerate(found)]}
    try:
        target.write_bytes(f"{page['submission_id']}/{name}", json.dumps(payload, ensure_ascii=False, indent=2).encode("utf-8"))
    except Exception as problem:
        return {**page, "status": FAILED, "error": STAGES["write"] + str(problem), "lines_filename": ""}
    return {**page, "status": COMPLETED, "error": "", "lines_filename": name}


def extracted(docs: DataFrame, providers: Providers, source: Storage, target: Storage, batch: int = 16, journal: Journal | None = None) -> DataFrame:
    """Page rows of ``docs`` (submission_id, source_path, doc_filename, position, pdf, cached), images and lines written on the way.

    A task reads one document at a time and keeps no image of a page that is done.
    What no row of a page can tell gives a row that is ``broken``: it fails the
    whole submission. ``journal`` is told of each document that is begun and, unless
    it is broken, finished.
    """

    def run(batches):
        import pandas as pd

        try:
            made, problem = providers.made(), None
        except Exception as error:
            made, problem = None, error
        beat = journal.beat() if journal else None
        for rows in batches:
            out = []
            for doc in rows.to_dict("records"):
                if made is None:
                    out.append(_row(doc, 0, error=str(problem), broken=True))
                    continue
                path = f"{doc['source_path']}/{doc['doc_filename']}"
                if beat:
                    beat.at(doc)
                    stamp, own = source.stamp(path), []
                try:
                    doc |= {"content": source.read_bytes(path), "error": ""}
                except Exception as problem:
                    doc |= {"content": None, "error": str(problem) or type(problem).__name__}
                try:
                    for page in pages_of(doc, made, target):
                        out.append({**with_lines(page, made, target), "image": None})
                        if beat:
                            own.append(out[-1])
                        if len(out) >= batch:
                            yield pd.DataFrame(out)
                            out = []
                    if beat:
                        journal.record(doc, stamp, own)
                except Exception as error:
                    out.append(_row(doc, 0, error=str(error), broken=True))
                if beat:
                    beat.done()
            if out:
                yield pd.DataFrame(out)
        if beat:
            beat.end()

    return docs.mapInPandas(run, PAGES)


def with_raw_images(pages: DataFrame, providers: Providers, source: Storage, target: Storage) -> DataFrame:
    """Pages (the manifest's columns, source_path, pdf, rotation) with their raw image made from the source; a page that fails stays as it was."""
    keep = [c for c in pages.columns if c not in ("source_path", "pdf", "rotation")]

    def one(row: dict[str, Any], made: _Made) -> dict[str, Any]:
        content = source.read_bytes(f"{row['source_path']}/{row['doc_filename']}")
        number = int(row["page_number"])
        if row["pdf"]:
            jpeg = next((p for k, p in enumerate(made.rasterizer.pages(content), 1) if k == number), None)
            if jpeg is None:
                return row
            if isinstance(jpeg, Exception):
                raise jpeg
        else:
            jpeg = made.images.to_jpeg(content)
        done = made.transformed(jpeg, [{"rotation": int(row["rotation"] or 0)}], redetect=False)
        if done.raw is None:
            return row
        name = f"{stem(row['doc_filename'])}_p{number}.{extensions(made.images)[1]}"
        target.write_bytes(f"{row['submission_id']}/{name}", done.raw)
        new = {"raw_image_filename": name, "raw_image_width": done.raw_width, "raw_image_height": done.raw_height}
        patch_lines(target, row["submission_id"], row["lines_filename"], new)
        return {**row, **new}

    def run(batches):
        import pandas as pd

        made = providers.made()
        for rows in batches:
            out = []
            for row in rows.to_dict("records"):
                try:
                    row = one(row, made)
                except Exception:
                    pass  # the manifest keeps what it has
                out.append({k: row[k] for k in keep})
            yield pd.DataFrame(out, columns=keep)

    return pages.mapInPandas(run, pages.select(*keep).schema)


def patch_lines(target: Storage, submission_id: str, lines_filename: str, new: dict[str, Any]) -> bool:
    """Put ``new`` into a lines file, other keys as they are; False if there is none or it cannot be read or written."""
    if not lines_filename:
        return False
    place = f"{submission_id}/{lines_filename}"
    try:
        payload = json.loads(target.read_text(place)) | new
        target.write_bytes(place, json.dumps(payload, ensure_ascii=False, indent=2).encode("utf-8"))
    except Exception:
        return False
    return True
