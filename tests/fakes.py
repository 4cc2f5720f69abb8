"""Providers that need no image library: a document is text, a page is a line of it."""

import time

from pagewright.operators.imaging import Providers, Transformed, target_size


class Pages:
    def pages(self, content):
        if not content.startswith(b"PDF"):
            raise ValueError("no such format")
        for line in content.decode().split("\n")[1:]:
            yield ValueError("page is torn") if line == "torn" else line.encode()


class Images:
    def to_jpeg(self, content):
        if content == b"blob":
            raise ValueError("not an image")
        return b"jpeg:" + content

    def transform(self, image, rotation, find, options):
        if b"thin" in image:
            target_size(9000, 1, options.max_dimension)
        turn = find(image) if rotation is None else rotation
        return Transformed(image + b"@%d" % (turn or 0), None if b"noraw" in image else b"raw:" + image, 30, 20, {"rotation": turn})

    def size(self, image):
        return 15, 10


def bad_rotator(image):
    raise OSError("no service")


def rotator(image):
    return 180 if b"upside" in image else None


class Detector:
    def __init__(self, options):
        self.options = options

    def detect(self, image):
        if b"blind" in image:
            raise ValueError("cannot see")
        if b"dim" in image:
            raise ValueError(f"seen at {self.options.text_threshold} and {self.options.blank_threshold}")
        return [{"bbox": [0.0, 0.0, 5.0, 5.0], "polygon": [[0.0, 0.0], [5.0, 0.0], [5.0, 5.0], [0.0, 5.0]], "confidence": None}, {"bbox": [1.0, 1.0, 9.0, 9.0], "polygon": [], "confidence": 0.5}]


def no_detector(options):
    raise OSError("weights are missing")


def no_rasterizer():
    raise OSError("no such library")


def made_for(settings):
    return Providers(Pages, Images, Detector, (bad_rotator, rotator))


class Noted(Pages):
    """A page "note FILE NAME" adds its name to a file when it is made; "wait SECONDS" takes its time."""

    def pages(self, content):
        for page in super().pages(content):
            word = page.split() if isinstance(page, bytes) else [b""]
            if word[0] == b"note":
                with open(word[1], "a") as f:
                    f.write(word[2].decode() + "\n")
            elif word[0] == b"wait":
                time.sleep(float(word[1]))
            yield page
