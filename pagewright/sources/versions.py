"""Manifests by versions, so that of two writers that began from the same state one loses, with an error.

A version is a record that names staged manifests and where they belong. It is put
only if there is none of its number, and that decides who wins; then the staged files
take their places. A run that ends between the two leaves the record, from which the
next one moves what is left: all manifests of a version come into force, or none.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession

from pagewright.sources.storage import Storage
from pagewright.sources.tables import stage_manifest

FOLDER = "_versions"
#: Records of so many versions stay.
KEPT = 50


class Conflict(RuntimeError):
    """Another writer has published since this one read the manifests; nothing of this one is in force."""


def _at(prefix: str, name: str) -> str:
    return f"{prefix}/{name}" if prefix else name


def _records(storage: Storage, prefix: str) -> dict[int, str]:
    names = {path.rsplit("/", 1)[-1]: path for path in storage.list_files(_at(prefix, FOLDER))}
    return {int(name.removesuffix(".json")): path for name, path in names.items() if name.removesuffix(".json").isdigit()}


def latest(storage: Storage, prefix: str = "") -> dict:
    """The record of the last version, after its manifests have taken their places; version 0 if there is none."""
    found = _records(storage, prefix)
    if not found:
        return {"version": 0, "state": {}}
    record = json.loads(storage.read_text(found[max(found)]))
    _settle(storage, record)
    return record


def current(storage: Storage, prefix: str = "") -> int:
    return latest(storage, prefix)["version"]


def _settle(storage: Storage, record: dict) -> None:
    for staged, path in record["files"]:
        try:
            storage.move(staged, path)
        except FileNotFoundError:  # moved already
            continue
    storage.delete_folder(record["folder"])


def publish(spark: SparkSession, storage: Storage, prefix: str, base: int, manifests: dict[str, tuple[DataFrame, tuple[str, ...]]], state: dict[str, str] | None = None) -> int:
    """Put ``manifests`` (name: rows and sort keys) in force as the version after ``base``; Conflict if there is one already. ``state`` names tables of the same rows."""
    number, folder = base + 1, _at(prefix, f"{FOLDER}/staged-{uuid.uuid4().hex}")
    files = [(stage_manifest(df, storage, f"{folder}/{name}", keys), _at(prefix, name)) for name, (df, keys) in manifests.items()]
    record = {"version": number, "folder": folder, "files": files, "state": state or {}}
    if not put_if_absent(spark, storage, _at(prefix, f"{FOLDER}/{number:012d}.json"), json.dumps(record).encode("utf-8")):
        storage.delete_folder(folder)
        raise Conflict(f"version {number} of the manifests is another writer's")
    _settle(storage, record)
    for old in sorted(_records(storage, prefix).items())[:-KEPT]:
        storage.delete(old[1])
    return number


def put_if_absent(spark: SparkSession, storage: Storage, path: str, data: bytes) -> bool:
    """Write a file whole unless there is one; False if there is. Of two callers at once, one gets True."""
    if not storage.uri(path).startswith("file:"):
        return _put_by_hadoop(spark, storage, path, data)
    place = storage.absolute(path)
    os.makedirs(posixpath.dirname(place), exist_ok=True)
    own = f"{place}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(data)
    try:
        os.link(own, place)  # fails where there is one, and shows no half of it
    except FileExistsError:
        return False
    finally:
        os.unlink(own)
    return True


def _put_by_hadoop(spark: SparkSession, storage: Storage, path: str, data: bytes) -> bool:
    """By Spark's file systems: a store that can put on condition is asked to."""
    storage.prepare(spark)
    place = spark._jvm.org.apache.hadoop.fs.Path(storage.uri(path))
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = fs.createFile(place).overwrite(False).recursive().opt("fs.option.create.conditional.overwrite", "true").build()
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    except Exception:
        if fs.exists(place):  # another was faster
            return False
        raise
    return True
