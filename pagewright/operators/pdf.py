"""The scans in PDF documents, one for each page, without a library.

A scanner's document holds one image a page. The objects that lead there are read
one by one: the cross-reference (tables and streams, of all updates), the page tree,
the page's image. Pages of drawn text have no scan, and are told so as errors of
their own; a document that is encrypted or no PDF does not open.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
from pyspark.sql.functions import udtf

from pagewright.operators.pixels import unfiltered, write_png

_SPACE = re.compile(rb"(?:[\x00\t\n\x0c\r ]|%[^\r\n]*)*")
_NUMBER = re.compile(rb"[+-]?(?:\d+\.?\d*|\.\d+)")
_REFERENCE = re.compile(rb"(\d+)[\x00\t\n\x0c\r ]+(\d+)[\x00\t\n\x0c\r ]+R(?![A-Za-z])")
_NAME = re.compile(rb"/([^\x00\t\n\x0c\r ()<>\[\]{}/%]*)")
_WORD = re.compile(rb"[A-Za-z*'\"]+")
_OBJECT = re.compile(rb"(?<!\d)(\d+)[\x00\t\n\x0c\r ]+(\d+)[\x00\t\n\x0c\r ]+obj")
#: How deep values and page trees may be nested, and filters chained.
DEPTH = 100


class Ref(int):
    """The number of an object that is elsewhere."""


class Name(str):
    pass


class Stream:
    def __init__(self, told: dict[str, Any], raw: bytes) -> None:
        self.told, self.raw = told, raw


class _Reader:
    """Values one after another from a place on."""

    def __init__(self, data: bytes, at: int) -> None:
        self.data, self.at = data, at

    def skip(self) -> None:
        self.at = _SPACE.match(self.data, self.at).end()

    def value(self, depth: int = 0) -> Any:
        self.skip()
        data, at = self.data, self.at
        if depth > DEPTH:
            raise ValueError("values are nested too deeply")
        if data.startswith(b"<<", at):
            self.at += 2
            return self._dictionary(depth)
        if data[at : at + 1] == b"[":
            self.at += 1
            out = []
            while not self._ends(b"]"):
                out.append(self.value(depth + 1))
            return out
        if data[at : at + 1] == b"<":
            end = data.index(b">", at)
            self.at = end + 1
            return bytes.fromhex(re.sub(rb"\s", b"", data[at + 1 : end]).decode("ascii") + "0" * (len(re.sub(rb"\s", b"", data[at + 1 : end])) % 2))
        if data[at : at + 1] == b"(":
            return self._text()
        for pattern, make in ((_REFERENCE, lambda m: Ref(m[1])), (_NAME, lambda m: Name(m[1].decode("latin-1"))), (_NUMBER, lambda m: float(m[0]) if b"." in m[0] else int(m[0]))):
            if found := pattern.match(data, at):
                self.at = found.end()
                return make(found)
        if found := _WORD.match(data, at):
            self.at = found.end()
            return {b"true": True, b"false": False, b"null": None}.get(found[0], found[0])
        raise ValueError(f"no value at byte {at}")

    def _ends(self, sign: bytes) -> bool:
        self.skip()
        if self.at >= len(self.data):
            raise ValueError("the document ends early")
        if self.data.startswith(sign, self.at):
            self.at += len(sign)
            return True
        return False

    def _dictionary(self, depth: int) -> dict[str, Any]:
        out: dict[str, Any] = {}
        while not self._ends(b">>"):
            key = self.value(depth + 1)
            out[str(key)] = self.value(depth + 1)
        return out

    def _text(self) -> bytes:
        start, level = self.at + 1, 0
        for found in re.compile(rb"\\.|[()]", re.DOTALL).finditer(self.data, self.at):
            level += {b"(": 1, b")": -1}.get(found[0], 0)
            if level == 0:
                self.at = found.end()
                return self.data[start : found.start()]
        raise ValueError("a text does not end")


class Document:
    """The objects of a PDF by number; ValueError if it does not open."""

    def __init__(self, data: bytes) -> None:
        if b"%PDF-" not in data[:1024]:
            raise ValueError("not a PDF document")
        self.data, self.places, self.kept = data, {}, {}
        self.trailer: dict[str, Any] = {}
        try:
            self._references(int(re.compile(rb"startxref\s+(\d+)").findall(data[-2048:])[-1]))
            self._root()
        except (ValueError, IndexError, KeyError, TypeError, AttributeError, zlib.error):
            self._searched()
        if "Encrypt" in self.trailer:
            raise ValueError("the document is encrypted")
        self._root()

    def _root(self) -> dict[str, Any]:
        pages = self.get(self.get(self.trailer.get("Root")).get("Pages")) if isinstance(self.get(self.trailer.get("Root")), dict) else None
        if not isinstance(pages, dict):
            raise ValueError("the document has no page tree")
        return pages

    def _references(self, at: int) -> None:
        """Places of objects, from the last update back to the first; what a later one says counts."""
        seen: set[int] = set()
        while at not in seen:
            seen.add(at)
            reader = _Reader(self.data, at)
            reader.skip()
            if self.data.startswith(b"xref", reader.at):
                reader.at += 4
                while not isinstance(start := reader.value(), bytes):
                    for k in range(start, start + reader.value()):
                        place, _, kind = reader.value(), reader.value(), reader.value()
                        if kind == b"n":
                            self.places.setdefault(k, (place, None))
                told = reader.value()
                if "XRefStm" in told:
                    self._reference_stream(self._object(told["XRefStm"]))
            else:
                stream = self._object(at)
                self._reference_stream(stream)
                told = stream.told
            self.trailer = {**told, **self.trailer}
            if "Prev" not in told:
                return
            at = told["Prev"]

    def _reference_stream(self, stream: Stream) -> None:
        data, widths = self.decoded(stream)[0], stream.told["W"]
        index = stream.told.get("Index", [0, stream.told["Size"]])
        numbers = [k for start, n in zip(index[::2], index[1::2], strict=True) for k in range(start, start + n)]
        for row, k in enumerate(numbers):
            at, fields = row * sum(widths), []
            for w in widths:
                fields.append(int.from_bytes(data[at : at + w]) if w else 1)
                at += w
            if fields[0] == 1:
                self.places.setdefault(k, (fields[1], None))
            elif fields[0] == 2:  # in a stream of objects
                self.places.setdefault(k, (fields[2], fields[1]))

    def _searched(self) -> None:
        """Where the cross-reference is damaged, objects are looked for; of equal numbers the last counts."""
        self.places, self.kept, self.trailer = {int(m[1]): (m.start(), None) for m in _OBJECT.finditer(self.data)}, {}, {}
        for found in re.finditer(rb"trailer", self.data):
            try:
                self.trailer |= _Reader(self.data, found.end()).value()
            except ValueError:
                continue
        for k in list(self.places):
            if "Root" not in self.trailer and isinstance(value := self.get(Ref(k)), dict) and value.get("Type") == "Catalog":
                self.trailer["Root"] = Ref(k)

    def _object(self, at: int) -> Any:
        found = _OBJECT.match(self.data, _SPACE.match(self.data, at).end())
        if not found:
            raise ValueError(f"no object at byte {at}")
        reader = _Reader(self.data, found.end())
        value = reader.value()
        reader.skip()
        if isinstance(value, dict) and self.data.startswith(b"stream", reader.at):
            start = reader.at + 6
            start += 2 if self.data.startswith(b"\r\n", start) else 1
            size = self.get(value.get("Length"))
            if not isinstance(size, int) or not _SPACE.match(self.data, start + size) or not re.match(rb"\s*endstream", self.data[start + size : start + size + 16]):
                size = self.data.index(b"endstream", start) - start
            return Stream(value, self.data[start : start + size])
        return value

    def get(self, value: Any) -> Any:
        """A value itself, or the object that it refers to; None for one that there is not."""
        for _ in range(DEPTH):
            if not isinstance(value, Ref):
                return value
            place, within = self.places.get(int(value), (None, None))
            if place is None:
                return None
            value = self._object(place) if within is None else self._packed(within).get(int(value))
        raise ValueError("references go in a circle")

    def _packed(self, number: int) -> dict[int, Any]:
        if number not in self.kept:
            stream = self.get(Ref(number))
            data, first, n = self.decoded(stream)[0], self.get(stream.told["First"]), self.get(stream.told["N"])
            reader = _Reader(data, 0)
            heads = [(reader.value(), reader.value()) for _ in range(n)]
            self.kept = {number: {k: _Reader(data, first + at).value() for k, at in heads}}  # one stream is held
        return self.kept[number]

    def decoded(self, stream: Stream) -> tuple[bytes, str]:
        """The data after the filters that can be undone, and the name of the one that is left, or ''."""
        data = stream.raw
        filters, settings = self.get(stream.told.get("Filter")), self.get(stream.told.get("DecodeParms"))
        filters = filters if isinstance(filters, list) else [filters] if filters else []
        settings = settings if isinstance(settings, list) else [settings]
        for k, name in enumerate(map(self.get, filters)):
            if name not in ("FlateDecode", "Fl"):
                return data, str(name)
            data = zlib.decompressobj().decompress(data)
            own = self.get(settings[k]) if k < len(settings) and settings[k] else {}
            if (own or {}).get("Predictor", 1) >= 10:
                step = max(1, own.get("Colors", 1) * own.get("BitsPerComponent", 8) // 8)
                wide = (own.get("Columns", 1) * own.get("Colors", 1) * own.get("BitsPerComponent", 8) + 7) // 8 + 1
                data = unfiltered(np.frombuffer(data[: len(data) // wide * wide], np.uint8).reshape(-1, wide), step).tobytes()
        return data, ""

    def pages(self) -> Iterator[dict[str, Any]]:
        """Pages in order, with the resources that they inherit."""
        left: list[tuple[Any, Any, int]] = [(self._root(), None, 0)]
        while left:
            node, resources, depth = left.pop()
            node = self.get(node)
            if not isinstance(node, dict) or depth > DEPTH:
                raise ValueError("the page tree is damaged")
            own = node.get("Resources", resources)
            if "Kids" in node:
                left += [(kid, own, depth + 1) for kid in reversed(self.get(node["Kids"]))]
            else:
                yield {**node, "Resources": own}

    def scan(self, page: dict[str, Any]) -> bytes:
        """The image of a page as JPEG or PNG; of several the one with the most pixels. ValueError where there is none that can be had."""
        images = self.get((self.get(page["Resources"]) or {}).get("XObject")) or {}
        found = [s for s in map(self.get, images.values()) if isinstance(s, Stream) and s.told.get("Subtype") == "Image"]
        if not found:
            raise ValueError("the page has no scan")
        best = max(found, key=lambda s: self.get(s.told["Width"]) * self.get(s.told["Height"]))
        data, coded = self.decoded(best)
        if coded in ("DCTDecode", "DCT"):
            return data
        width, height, colours = self.get(best.told["Width"]), self.get(best.told["Height"]), self.get(best.told.get("ColorSpace"))
        samples = {"DeviceRGB": 3, "DeviceGray": 1}.get(str(colours))
        if coded or samples is None or self.get(best.told.get("BitsPerComponent")) != 8 or len(data) < width * height * samples:
            raise ValueError(f"the page's scan cannot be read: {coded or colours}")
        pixels = np.frombuffer(data, np.uint8)[: width * height * samples].reshape(height, width, samples)
        return write_png(pixels if samples == 3 else np.repeat(pixels, 3, axis=2))


class ScannedPdf:
    """A rasterizer for runs whose documents are scans."""

    def pages(self, content: bytes) -> Iterator[bytes | Exception]:
        document = Document(content)

        def each() -> Iterator[bytes | Exception]:
            for page in document.pages():
                try:
                    yield document.scan(page)
                except Exception as problem:
                    yield problem

        return each()


@udtf(returnType="page_number int, image binary, error string")
class PdfPages:
    """A row for each page of a document: its scan, or why there is none. One that does not open has one row, page 0."""

    def eval(self, content: bytes):
        if content is None:
            return
        number = 0
        try:
            for number, page in enumerate(ScannedPdf().pages(content), 1):
                yield (number, None, str(page)) if isinstance(page, Exception) else (number, page, None)
        except Exception as problem:
            yield number and number + 1, None, str(problem)
