"""Providers for scans in PNG that need no image library: pixels are arrays.

They do what a run asks of providers (see imaging) for pages of printed or drawn
lines; handwriting and photographs are better served by a trained detector, and other
formats by a library, through the same protocols.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np

from pagewright.operators.imaging import Options, Rotator, Transformed, target_size

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel for each colour type that can be read.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
#: Darkness from which a pixel belongs to a line, and that one of its pixels must have, unless the options say otherwise.
BLANK, TEXT = 0.35, 0.6


def _chunks(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(_SIGNATURE)
    while at + 8 <= len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        data = content[at + 8 : at + 8 + size]
        if len(data) < size:
            raise ValueError("the image ends early")
        yield kind, data
        at += 12 + size


def unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """Rows of bytes, each after its filter's number, as they were before the filters."""
    out = np.zeros((len(rows), rows.shape[1] - 1), dtype=np.uint8)
    above = np.zeros(out.shape[1], dtype=np.uint8)
    for k, (kind, raw) in enumerate(zip(rows[:, 0], rows[:, 1:], strict=True)):
        if kind == 0:
            row = raw
        elif kind == 1:
            row = np.cumsum(raw.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            row = raw + above
        elif kind in (3, 4):
            row = _by_neighbours(raw.tolist(), above.tolist(), step, kind == 4)
        else:
            raise ValueError(f"no such filter: {kind}")
        out[k] = above = row
    return out


def _by_neighbours(raw: list[int], above: list[int], step: int, nearest: bool) -> np.ndarray:
    row = [0] * len(raw)
    for i, value in enumerate(raw):
        left, up, corner = (row[i - step], above[i], above[i - step]) if i >= step else (0, above[i], 0)
        if nearest:  # whichever of the three is nearest to left + up - corner, in this order
            a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
            guess = left if a <= b and a <= c else up if b <= c else corner
        else:
            guess = (left + up) // 2
        row[i] = (value + guess) & 255
    return np.array(row, dtype=np.uint8)


def read_png(content: bytes) -> tuple[np.ndarray, bytes]:
    """Red, green and blue of each pixel, and the EXIF data (or none); ValueError for what is no such image. Transparency is over white."""
    if not content.startswith(_SIGNATURE):
        raise ValueError("not a PNG image")
    parts: dict[bytes, bytes] = {}
    for kind, data in _chunks(content):
        parts[kind] = parts.get(kind, b"") + data if kind == b"IDAT" else data
    try:
        width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", parts[b"IHDR"])
        packed = zlib.decompress(parts[b"IDAT"])
    except (KeyError, struct.error, zlib.error) as problem:
        raise ValueError(f"a damaged image: {problem}") from problem
    if depth != 8 or interlaced or colour not in _SAMPLES:
        raise ValueError(f"{depth} bits of colour type {colour}{', interlaced,' if interlaced else ''} cannot be read")
    samples = _SAMPLES[colour]
    if len(packed) != height * (1 + width * samples) or not width or not height:
        raise ValueError("the image ends early")
    pixels = unfiltered(np.frombuffer(packed, np.uint8).reshape(height, -1), samples).reshape(height, width, samples)
    if colour == 3:
        palette = np.frombuffer(parts.get(b"PLTE", b""), np.uint8).reshape(-1, 3)
        if pixels.max() >= len(palette):
            raise ValueError("a colour that is not in the palette")
        pixels = palette[pixels[..., 0]]
    elif colour in (4, 6):
        seen = pixels[..., -1:].astype(np.uint16)
        pixels = ((pixels[..., :-1] * seen + 255 * (255 - seen) + 127) // 255).astype(np.uint8)
    return (pixels if pixels.shape[2] == 3 else np.repeat(pixels, 3, axis=2)), parts.get(b"eXIf", b"")


def write_png(pixels: np.ndarray, exif: bytes = b"") -> bytes:
    height, width = pixels.shape[:2]
    rows = np.zeros((height, 1 + 3 * width), dtype=np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
    return _SIGNATURE + head + (chunk(b"eXIf", exif) if exif else b"") + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def orientation(exif: bytes) -> int:
    """The orientation, 1 to 8, of a TIFF directory in either order of bytes; 1 where none is told."""
    exif = exif.removeprefix(b"Exif\0\0")
    order = {b"II": "<", b"MM": ">"}.get(exif[:2])
    try:
        magic, at = struct.unpack_from(f"{order}HI", exif, 2) if order else (0, 0)
        if magic != 42:
            return 1
        (entries,) = struct.unpack_from(f"{order}H", exif, at)
        for k in range(entries):
            tag, kind, n, value = struct.unpack_from(f"{order}HHIH", exif, at + 2 + 12 * k)
            if (tag, kind, n) == (0x0112, 3, 1):
                return value if 1 <= value <= 8 else 1
    except struct.error:
        pass
    return 1


def upright(pixels: np.ndarray, told: int) -> np.ndarray:
    """As an image of this orientation is to be seen."""
    if told in (2, 4):
        return pixels[:, ::-1] if told == 2 else pixels[::-1]
    if told in (5, 7):
        turned = np.swapaxes(pixels, 0, 1)
        return turned if told == 5 else turned[::-1, ::-1]
    return np.rot90(pixels, {3: 2, 6: -1, 8: 1}.get(told, 0))


def reduced(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Each pixel the mean of the area that it stands for."""

    def along(values: np.ndarray, n: int) -> np.ndarray:
        if n == len(values):
            return values
        sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
        edges = np.linspace(0, len(values), n + 1)
        low = np.minimum(edges.astype(int), len(values) - 1)
        part = (edges - low).reshape(-1, *[1] * (values.ndim - 1))
        at = sums[low] + part * (sums[low + 1] - sums[low])
        return np.diff(at, axis=0) * (n / len(values))

    rows = along(pixels.astype(np.float64), height)
    return np.clip(np.rint(np.swapaxes(along(np.swapaxes(rows, 0, 1), width), 0, 1)), 0, 255).astype(np.uint8)


def darkness(pixels: np.ndarray) -> np.ndarray:
    """0 for white to 1 for black."""
    return 1 - pixels @ np.array([0.299, 0.587, 0.114]) / 255


class PngImages:
    """The images of a run, in PNG from beginning to end."""

    extension, raw_extension = "png", "raw.png"

    def to_jpeg(self, content: bytes) -> bytes:
        """In red, green and blue with its EXIF data, but as PNG."""
        return write_png(*read_png(content))

    def transform(self, image: bytes, rotation: int | None, find: Rotator, options: Options) -> Transformed:
        try:
            pixels, exif = read_png(image)
        except ValueError:
            return Transformed(image, None, 0, 0, {"rotation": rotation})
        whole = upright(pixels, orientation(exif))
        size = whole.shape[1], whole.shape[0]
        to = target_size(*size, options.max_dimension)
        small = whole if to == size else reduced(whole, *to)
        turn = find(write_png(small)) if rotation is None else rotation
        applied: dict[str, Any] = {"rotation": turn} | ({"original_size": list(size)} if to != size else {})
        full = np.rot90(whole, -(turn or 0) // 90)
        return Transformed(write_png(np.rot90(small, -(turn or 0) // 90)), write_png(full), full.shape[1], full.shape[0], applied)

    def size(self, image: bytes) -> tuple[int, int]:
        pixels, _ = read_png(image)
        return pixels.shape[1], pixels.shape[0]


class NoDocuments:
    """Stands where documents of many pages cannot be opened."""

    def pages(self, content: bytes) -> Iterator[bytes]:
        raise ValueError("documents of pages cannot be read here")


def _sharpness(dark: np.ndarray) -> float:
    """How much the ink of one row differs from that of the next, in all."""
    return float(np.square(np.diff(dark.mean(axis=1))).sum())


def _ragged(dark: np.ndarray) -> tuple[float, float]:
    """How far the first and the last ink of the rows that have any lie from where most begin and end."""
    ink = dark >= BLANK
    rows = ink[ink.any(axis=1)]
    first, last = rows.argmax(axis=1), rows[:, ::-1].argmax(axis=1)
    return float(np.abs(first - np.median(first)).mean()), float(np.abs(last - np.median(last)).mean())


def quarter_turn(image: bytes) -> int | None:
    """Degrees clockwise that turn a page of lines upright: lines are seen in the profile of rows, and begin at one margin; None where that does not show."""
    dark = darkness(read_png(image)[0])
    if not (dark >= BLANK).any():
        return None
    across, down = _sharpness(dark), _sharpness(dark.T)
    if max(across, down) < 2 * min(across, down):
        return None
    lying = down > across
    begin, end = _ragged(dark.T if lying else dark)
    if max(begin, end) < 2 * min(begin, end) + 1:
        return None
    return (270 if begin < end else 90) if lying else (0 if begin < end else 180)


class RunLengthDetector:
    """Lines as connected parts of what is left of a page when short gaps in its rows are filled.

    A pixel of at least the blank threshold's darkness is ink, and a part counts if one
    of its pixels reaches the text threshold's. A gap is filled up to a fortieth of the width,
    8 pixels at least; rows are connected across two rows without ink.
    """

    def __init__(self, options: Options) -> None:
        self.blank = BLANK if options.blank_threshold is None else options.blank_threshold
        self.text = TEXT if options.text_threshold is None else options.text_threshold

    def runs(self, ink: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Row, first and end of each run of ink, with short gaps filled."""
        gap = max(8, ink.shape[1] // 40)
        edges = np.diff(np.pad(ink.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        for y in np.flatnonzero(ink.any(axis=1)).tolist():
            starts, ends = np.flatnonzero(edges[y] == 1), np.flatnonzero(edges[y] == -1)
            apart = starts[1:] - ends[:-1] > gap
            yield from zip([y] * (int(apart.sum()) + 1), [int(starts[0]), *starts[1:][apart].tolist()], [*ends[:-1][apart].tolist(), int(ends[-1])], strict=True)

    def detect(self, image: bytes) -> list[dict[str, Any]]:
        dark = darkness(read_png(image)[0])
        runs = list(self.runs(dark >= self.blank))
        head = list(range(len(runs)))

        def find(k: int) -> int:
            while head[k] != k:
                head[k] = head[head[k]]
                k = head[k]
            return k

        behind = 0
        for k, (y, start, end) in enumerate(runs):
            while runs[behind][0] < y - 3:
                behind += 1
            for j in range(behind, k):
                if runs[j][0] < y and runs[j][1] < end and start < runs[j][2]:
                    head[find(k)] = find(j)
        boxes: dict[int, list[int]] = {}
        for k, (y, start, end) in enumerate(runs):
            box = boxes.setdefault(find(k), [start, y, end, y + 1])
            box[:] = min(box[0], start), min(box[1], y), max(box[2], end), max(box[3], y + 1)
        lines = []
        for x0, y0, x1, y1 in sorted(boxes.values(), key=lambda b: (b[1], b[0])):
            own = dark[y0:y1, x0:x1]
            if own.max() >= self.text:
                box = [float(v) for v in (x0, y0, x1, y1)]
                corners = [[box[0], box[1]], [box[2], box[1]], [box[2], box[3]], [box[0], box[3]]]
                lines.append({"bbox": box, "polygon": corners, "confidence": round(float(own[own >= self.blank].mean()), 6)})
        return lines
