"""Files under one root, local or in an object store, on the driver and inside tasks.

The driver looks at small things (manifests, probes); everything that grows with
the corpus is listed and read by tasks, through the same class.
"""

from __future__ import annotations

import posixpath
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime
from typing import TypeVar

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from pagewright.settings import Side

T = TypeVar("T")

#: Tries of a write or delete, and the seconds between them.
ATTEMPTS, DELAYS = 3, (0.5, 1.0)


def with_retry(call: Callable[[], T], attempts: int = ATTEMPTS, delays: Iterable[float] = DELAYS, sleep: Callable[[float], None] = time.sleep) -> T:
    """``call()``, again after any exception until ``attempts`` are used up; then the last one is raised."""
    waits = list(delays) or [0.0]
    for k in range(attempts):
        try:
            return call()
        except Exception:
            if k + 1 == attempts:
                raise
            sleep(waits[min(k, len(waits) - 1)])
    raise ValueError("attempts must be at least 1")


@dataclass(frozen=True)
class Storage:
    """A root that paths do not leave. It can be sent to tasks: file systems open where they are used."""

    root: str
    side: Side | None = None

    def _open(self) -> pafs.FileSystem:
        if self.side is not None and self.side.kind == "s3":
            given = {"access_key": self.side.key_id or None, "secret_key": self.side.secret or None, "region": self.side.region or None}
            return pafs.S3FileSystem(**{k: v for k, v in given.items() if v})
        if "://" in self.root and not self.root.startswith("file:"):
            return pafs.FileSystem.from_uri(self.root)[0]
        return pafs.LocalFileSystem()

    @property
    def base(self) -> str:
        text = self.root.split("://", 1)[1] if "://" in self.root else self.root.removeprefix("file:")
        return text.rstrip("/")

    def absolute(self, path: str) -> str:
        """The place of ``path``; ValueError if that lies outside the root."""
        inner = posixpath.normpath(path.replace("\\", "/").lstrip("/") or ".")
        if inner == ".." or inner.startswith("../"):
            raise ValueError(f"{path!r} lies outside the storage")
        return self.base if inner == "." else f"{self.base}/{inner}"

    def uri(self, path: str = "") -> str:
        """The address of ``path`` for Spark's readers and writers, with its scheme: a bucket's is s3a."""
        scheme = self.root.split("://", 1)[0] if "://" in self.root else "file"
        place = self.absolute(path)
        return f"file://{place}" if scheme == "file" else f"{'s3a' if scheme == 's3' else scheme}://{place}"

    def hadoop_settings(self) -> dict[str, str]:
        """What Spark must know to read and write here with this side's own credentials."""
        if self.side is None or self.side.kind != "s3":
            return {}
        bucket = self.base.split("/", 1)[0]
        given = {"access.key": self.side.key_id, "secret.key": self.side.secret, "endpoint.region": self.side.region}
        return {f"fs.s3a.bucket.{bucket}.{k}": v for k, v in given.items() if v}

    def prepare(self, spark: SparkSession) -> None:
        """Let Spark's readers and writers in; each bucket has its own settings, so two sides do not mix."""
        for name, value in self.hadoop_settings().items():
            spark.sparkContext._jsc.hadoopConfiguration().set(name, value)

    def _relative(self, place: str) -> str:
        return place[len(self.base) :].lstrip("/")

    def _children(self, prefix: str, recursive: bool = False) -> list[pafs.FileInfo]:
        return self._open().get_file_info(pafs.FileSelector(self.absolute(prefix), allow_not_found=True, recursive=recursive))

    def list_prefixes(self, prefix: str = "") -> list[str]:
        """Folders right under ``prefix``, sorted, each with a final slash; none if it is absent."""
        return sorted(f"{self._relative(i.path)}/" for i in self._children(prefix) if i.type == pafs.FileType.Directory)

    def list_files(self, prefix: str = "") -> list[str]:
        return sorted(self._relative(i.path) for i in self._children(prefix) if i.type == pafs.FileType.File)

    def entries(self, prefix: str = "") -> list[tuple[str, int | None, datetime | None, bool]]:
        """What lies right under ``prefix``, sorted: path, size, time and whether it is a folder."""
        return sorted(((self._relative(i.path), i.size, i.mtime, i.type == pafs.FileType.Directory) for i in self._children(prefix)), key=lambda e: e[0])

    def walk(self, prefix: str, name: str) -> list[str]:
        """Files of exactly this name at any depth, hidden folders too, sorted part by part."""
        found = [self._relative(i.path) for i in self._children(prefix, recursive=True) if i.type == pafs.FileType.File and i.base_name == name]
        return sorted(found, key=lambda p: p.split("/"))

    def exists(self, path: str) -> bool:
        """Files and folders; False for what lies outside the root."""
        try:
            place = self.absolute(path)
        except ValueError:
            return False
        return self._open().get_file_info(place).type != pafs.FileType.NotFound

    def opened(self, path: str) -> pa.NativeFile:
        return self._open().open_input_stream(self.absolute(path))

    def created(self, path: str) -> pa.NativeFile:
        """A stream over a new file, which is to be closed."""
        fs, place = self._open(), self.absolute(path)
        fs.create_dir(posixpath.dirname(place), recursive=True)
        return fs.open_output_stream(place)

    def read_bytes(self, path: str) -> bytes:
        with self._open().open_input_stream(self.absolute(path)) as f:
            return f.read()

    def read_text(self, path: str) -> str:
        return self.read_bytes(path).decode("utf-8")

    def write_bytes(self, path: str, data: bytes) -> None:
        """Whole and over what is there, so that a task that runs again does no harm."""
        place = self.absolute(path)

        def write() -> None:
            fs = self._open()
            fs.create_dir(posixpath.dirname(place), recursive=True)
            with fs.open_output_stream(place) as f:
                f.write(data)

        with_retry(write)

    def write_text(self, path: str, text: str) -> None:
        self.write_bytes(path, text.encode("utf-8"))

    def delete(self, path: str) -> None:
        """Also if it is gone already."""

        def remove() -> None:
            fs, place = self._open(), self.absolute(path)
            if fs.get_file_info(place).type == pafs.FileType.File:
                fs.delete_file(place)

        with_retry(remove)

    def move(self, path: str, to: str) -> None:
        """A file, over what is there; FileNotFoundError if there is none."""
        fs, place = self._open(), self.absolute(to)
        fs.create_dir(posixpath.dirname(place), recursive=True)
        fs.move(self.absolute(path), place)

    def delete_folder(self, path: str) -> None:
        """With all that is in it; also if it is gone already. The root stays."""
        place = self.absolute(path)
        if place == self.base:
            raise ValueError("the root is not deleted")
        fs = self._open()
        if fs.get_file_info(place).type == pafs.FileType.Directory:
            with_retry(lambda: fs.delete_dir(place))

    def stamp(self, path: str) -> str:
        """Tells versions of a file apart, by size and time; '' where there is none."""
        try:
            info = self._open().get_file_info(self.absolute(path))
        except Exception:
            return ""
        return "" if info.type == pafs.FileType.NotFound else f"{info.size}-{info.mtime_ns}"

    def probe_read(self) -> None:
        self.list_prefixes("")

    def probe_write(self) -> None:
        import uuid

        name = f"_probe_{uuid.uuid4().hex}"
        self.write_bytes(name, b"")
        try:
            self.delete(name)
        except Exception:
            import logging

            logging.getLogger(__name__).warning("cannot delete %s", name)


def open_side(side: Side) -> tuple[Storage, str]:
    """The storage of a side and the prefix in it: a local folder with none, or bucket and prefix of an s3:// address."""
    if side.kind == "local":
        return Storage(side.path, side), ""
    if side.kind != "s3":
        raise ValueError(f"no such storage type: {side.kind!r}")
    if not side.path.startswith("s3://"):
        raise ValueError(f"not an s3:// address: {side.path!r}")
    bucket, _, prefix = side.path.removeprefix("s3://").partition("/")
    return Storage(f"s3://{bucket}", side), prefix.rstrip("/")


#: How an error of ``reading`` begins where not the file but the storage is at fault.
NO_STORAGE = "no storage: "


def reading(storage: Storage, limit: int = 32_000_000) -> Callable[[Iterator], Iterator]:
    """For mapInPandas over rows with a column path: content and error of each file, in batches of about ``limit`` bytes."""

    def run(batches):
        import pandas as pd

        try:
            storage._open()
            unopened = None
        except Exception as problem:
            unopened = f"{NO_STORAGE}{problem}"
        for rows in batches:
            out, held = [], 0
            for row in rows.to_dict("records"):
                if unopened:
                    out.append({**row, "content": None, "error": unopened})
                    continue
                try:
                    content, error = storage.read_bytes(row["path"]), ""
                except Exception as problem:
                    content, error = None, str(problem)
                out.append({**row, "content": content, "error": error})
                held += len(content or b"")
                if held > limit:
                    yield pd.DataFrame(out)
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out)

    return run
