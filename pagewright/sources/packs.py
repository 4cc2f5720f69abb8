"""Data sources of Spark for files of a tree, and for artifacts packed together.

``pagewright_files`` reads a tree: the driver sees the folders of the upper levels and
deals them out, tasks walk what lies below. ``pagewright_packs`` writes many artifacts
as one file a task with an index beside it; a commit record of the job names the
indexes. Readers go by commit records alone, so what a failed task or job has left is
never seen, and nothing has to be moved.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from pagewright.sources.storage import Storage

FILES, PACKS = "pagewright_files", "pagewright_packs"
COMMITS, DATA = "_commits", "_packs"
#: Bytes and rows that a batch holds, about.
BATCH_BYTES, BATCH_ROWS = 16_000_000, 1000
#: Folders that the driver looks at, at most; a wider tree is listed by sources/discovery.
FOLDERS = 100_000

_FILE = pa.schema([("path", pa.string()), ("name", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("content", pa.binary())])
_PACKED = pa.schema([("path", pa.string()), ("commit", pa.string()), ("size", pa.int64()), ("content", pa.binary())])


def register(spark: SparkSession) -> None:
    """Let a session know both formats, and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Files)
    spark.dataSource.register(Packs)


def files(spark: SparkSession, storage: Storage, prefix: str = "", **options: str) -> DataFrame:
    """Files under a prefix: path, name, size, modified, content (null with content="false")."""
    register(spark)
    return spark.read.format(FILES).options(root=storage.root, prefix=prefix, **options).load()


def packed(spark: SparkSession, storage: Storage, prefix: str = "", **options: str) -> DataFrame:
    """Committed artifacts: path, commit, size, content (null with content="false"). Of equal paths the one of the greatest commit is the last."""
    register(spark)
    return spark.read.format(PACKS).options(root=storage.root, prefix=prefix, **options).load()


def pack(df: DataFrame, storage: Storage, prefix: str = "", overwrite: bool = False) -> None:
    """Write ``df`` (path, content) as one commit; with ``overwrite`` earlier ones are seen no more."""
    register(df.sparkSession)
    df.selectExpr("path", "CAST(content AS binary) AS content").write.format(PACKS).options(root=storage.root, prefix=prefix).mode("overwrite" if overwrite else "append").save()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row[-1] or b"")
        if held > BATCH_BYTES or len(out) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _at(prefix: str, name: str) -> str:
    return f"{prefix}/{name}" if prefix else name


class _Source(DataSource):
    def storage(self) -> Storage:
        if not self.options.get("root"):
            raise ValueError("the option root must name a folder or bucket")
        return Storage(self.options["root"])

    def prefix(self) -> str:
        return self.options.get("prefix", "").strip("/")

    def with_content(self) -> bool:
        return self.options.get("content", "true").lower() != "false"


@dataclass
class Folders(InputPartition):
    """Folders to walk wholly, and folders of which only the own files count."""

    whole: list[str]
    flat: list[str]


class Files(_Source):
    @classmethod
    def name(cls) -> str:
        return FILES

    def schema(self) -> str:
        return "path string, name string, size long, modified timestamp, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return FilesReader(self.storage(), self.prefix(), int(self.options.get("splits", "256")), self.with_content())


class FilesReader(DataSourceReader):
    def __init__(self, storage: Storage, prefix: str, splits: int, content: bool) -> None:
        self.storage, self.prefix, self.splits, self.content, self.names = storage, prefix, splits, content, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Files are opened only if their name is asked for."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("name",):
                asked = {f.value}
            elif isinstance(f, In) and f.attribute == ("name",):
                asked = set(f.value)
            else:
                yield f
                continue
            self.names = asked if self.names is None else self.names & asked

    def partitions(self) -> list[InputPartition]:
        level, flat = [self.prefix], []
        while level and len(level) < self.splits:
            below = [p.rstrip("/") for folder in level for p in self.storage.list_prefixes(folder)]
            if len(below) > FOLDERS:
                raise ValueError(f"over {FOLDERS} folders on one level; sources/discovery lists such a tree in tasks")
            flat += level
            level = below
        n = max(1, min(self.splits, len(level) + len(flat)))
        return [Folders(level[k::n], flat[k::n]) for k in range(n)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        return _batches(self._rows(partition), _FILE)

    def _rows(self, partition: Folders) -> Iterator[tuple]:
        left = [(f, True) for f in partition.whole] + [(f, False) for f in partition.flat]
        while left:
            folder, deeper = left.pop()
            for path, size, modified, is_folder in self.storage.entries(folder):
                name = path.rsplit("/", 1)[-1]
                if is_folder:
                    left += [(path, True)] if deeper else []
                elif self.names is None or name in self.names:
                    yield path, name, size, modified, self.storage.read_bytes(path) if self.content else None


@dataclass
class Index(InputPartition):
    """One task's artifacts of a commit."""

    commit: str
    path: str


@dataclass
class Written(WriterCommitMessage):
    """What one task has written; no index where it had no rows."""

    index: str | None
    pack: str | None
    rows: int


class Packs(_Source):
    @classmethod
    def name(cls) -> str:
        return PACKS

    def schema(self) -> str:
        return "path string, commit string, size long, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PacksReader(self.storage(), self.prefix(), self.with_content())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if not {"path", "content"} <= set(schema.names):
            raise ValueError("artifacts have a path and a content")
        return PacksWriter(self.storage(), self.prefix(), overwrite)


class PacksReader(DataSourceReader):
    def __init__(self, storage: Storage, prefix: str, content: bool) -> None:
        self.storage, self.prefix, self.content = storage, prefix, content

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.storage.list_files(_at(self.prefix, COMMITS)):
            told = json.loads(self.storage.read_text(path))
            commit = path.rsplit("/", 1)[-1].removesuffix(".json")
            out = [*([] if told["overwrite"] else out), *(Index(commit, i) for i in told["indexes"])]
        return out or [Index("", "")]

    def read(self, partition: Index) -> Iterator[pa.RecordBatch]:
        return _batches(self._rows(partition), _PACKED)

    def _rows(self, partition: Index) -> Iterator[tuple]:
        if not partition.path:
            return
        with self.storage.opened(f"{partition.path.removesuffix('.idx')}.pack") as pack, self.storage.opened(partition.path) as index:
            for table in pa.ipc.open_stream(index):
                for r in table.to_pylist():
                    content = None
                    if self.content:
                        content = pack.read(r["size"])  # in the order in which they were written
                        if zlib.crc32(content) != r["crc32"]:
                            raise OSError(f"{r['path']} in {partition.path} is damaged")
                    yield r["path"], partition.commit, r["size"], content


_INDEX = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("crc32", pa.int64())])


class PacksWriter(DataSourceArrowWriter):
    def __init__(self, storage: Storage, prefix: str, overwrite: bool) -> None:
        self.storage, self.prefix, self.overwrite = storage, prefix, overwrite
        self.job = f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name = _at(self.prefix, f"{DATA}/{self.job}/{uuid.uuid4().hex}")
        index, pack, at, rows = f"{name}.idx", f"{name}.pack", 0, 0
        try:
            with self.storage.created(pack) as out, self.storage.created(index) as told, pa.ipc.new_stream(told, _INDEX) as entries:
                for batch in iterator:
                    paths, found = batch.column("path").to_pylist(), []
                    for path, content in zip(paths, batch.column("content"), strict=True):
                        data = content.as_py()
                        if path is None or data is None:
                            continue
                        out.write(data)
                        found.append((path, at, len(data), zlib.crc32(data)))
                        at, rows = at + len(data), rows + 1
                    if found:
                        entries.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _INDEX, strict=True)], schema=_INDEX))
        except BaseException:
            self._gone(index, pack)
            raise
        if not rows:
            self._gone(index, pack)
            return Written(None, None, 0)
        return Written(index, pack, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """The job is seen from here on: one small file, put whole."""
        indexes = sorted(m.index for m in messages if m is not None and m.index)
        told = {"overwrite": self.overwrite, "indexes": indexes, "rows": sum(m.rows for m in messages if m is not None)}
        self.storage.write_text(_at(self.prefix, f"{COMMITS}/{self.job}.json"), json.dumps(told))

    def abort(self, messages: list[Written | None]) -> None:
        self.storage.delete_folder(_at(self.prefix, f"{DATA}/{self.job}"))

    def _gone(self, *paths: str) -> None:
        for path in paths:
            try:
                self.storage.delete(path)
            except Exception:  # no reader sees it
                pass


def vacuum(storage: Storage, prefix: str = "", older: float = 86_400.0) -> list[str]:
    """Delete what no commit in force names and is older than so many seconds: the jobs' folders that went. Commits are few; their packs are not looked into."""
    jobs = {i.path.rsplit("/", 2)[-2] for i in PacksReader(storage, prefix, False).partitions() if i.path}
    now, gone = time.time_ns(), []
    for folder in storage.list_prefixes(_at(prefix, DATA)):
        job = folder.rstrip("/").rsplit("/", 1)[-1]
        if job not in jobs and now - int(job.split("-")[0]) > older * 1e9:
            storage.delete_folder(folder.rstrip("/"))
            gone.append(job)
    return gone
