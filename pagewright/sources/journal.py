"""What a run has finished, document by document, and what its tasks are at.

A finished document is one file, written whole under a name that follows from the
document, so a task that runs again only writes it anew. A task keeps one more file
with the document it is at and how many it has finished; it goes when the task ends.
So progress can be told while a task runs, and a run that ended too early is carried
on where it was: what is in the journal is not made a second time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sources.storage import Storage

KEY = ("submission_id", "source_path", "doc_filename", "position")
_KEYS = "submission_id string, source_path string, doc_filename string, position int"
#: Folders that records are dealt to.
SHARDS = 256


@dataclass(frozen=True)
class Journal:
    """One in ``folder`` of ``storage``; it can be sent to tasks."""

    storage: Storage
    folder: str

    def place(self, doc: dict[str, Any]) -> str:
        told = json.dumps([doc["submission_id"], doc["source_path"], doc["doc_filename"], int(doc["position"])])
        name = hashlib.sha256(told.encode("utf-8")).hexdigest()
        return f"{self.folder}/done/{name[:2]}/{name}.json"

    def record(self, doc: dict[str, Any], stamp: str, pages: list[dict[str, Any]]) -> None:
        """``doc`` is finished; ``stamp`` tells the version of its file. A record that cannot be written costs no more than doing it again."""
        own = {**{k: doc[k] for k in KEY}, "position": int(doc["position"]), "stamp": stamp, "pages": [{k: v for k, v in p.items() if k != "image"} for p in pages]}
        try:
            self.storage.write_text(self.place(doc), json.dumps(own, ensure_ascii=False))
        except Exception:
            pass

    def begin(self) -> None:
        """What tasks of an earlier run have left of where they were is no news."""
        self.storage.delete_folder(f"{self.folder}/beats")

    def beat(self) -> Beat:
        context = TaskContext.get()
        return Beat(self, f"{context.stageId()}-{context.partitionId()}-{context.taskAttemptId()}" if context else "alone")

    def progress(self) -> tuple[object, list[str]]:
        """Something that differs once a task begins, finishes a document or ends, and the submissions and documents that tasks are at: a file a running task."""
        state, at = [], []
        for path in self.storage.list_files(f"{self.folder}/beats"):
            try:
                told = json.loads(self.storage.read_text(path))
            except Exception:  # just written or just gone
                continue
            state.append((path, told["finished"]))
            if told["document"] is not None:
                at.append(f"{told['submission_id']}/{told['document']}")
        return tuple(state), at

    def load(self, spark: SparkSession, pages: str) -> DataFrame:
        """All records: KEY, stamp, pages (an array of ``pages``, a type of SQL). Tasks list and read a share of the folders each."""

        def run(batches: Iterator) -> Iterator:
            import pandas as pd

            for shards in batches:
                for shard in shards["id"]:
                    out = []
                    for path in self.storage.list_files(f"{self.folder}/done/{shard:02x}"):
                        try:
                            told = json.loads(self.storage.read_text(path))
                        except Exception:  # no record is better than half of one
                            continue
                        out.append({**{k: told[k] for k in KEY}, "stamp": told["stamp"], "pages": json.dumps(told["pages"])})
                        if len(out) >= 1000:
                            yield pd.DataFrame(out)
                            out = []
                    if out:
                        yield pd.DataFrame(out)

        found = spark.range(0, SHARDS, 1, min(SHARDS, 4 * spark.sparkContext.defaultParallelism)).mapInPandas(run, f"{_KEYS}, stamp string, pages string")
        return found.withColumn("pages", F.from_json("pages", f"array<{pages}>"))

    def forget(self, docs: DataFrame) -> None:
        """Delete the records of ``docs`` (KEY), in tasks."""
        _each(docs, lambda doc: self.storage.delete(self.place(doc)))

    def clear(self) -> None:
        self.storage.delete_folder(self.folder)


class Beat:
    """What one task tells while it runs."""

    def __init__(self, journal: Journal, name: str) -> None:
        self.journal, self.place, self.finished = journal, f"{journal.folder}/beats/{name}.json", 0

    def at(self, doc: dict[str, Any]) -> None:
        told = {"finished": self.finished, "submission_id": doc["submission_id"], "document": doc["doc_filename"]}
        try:
            self.journal.storage.write_text(self.place, json.dumps(told))
        except Exception:  # a beat that is missed is no reason to fail
            pass

    def done(self) -> None:
        self.finished += 1

    def end(self) -> None:
        try:
            self.journal.storage.delete(self.place)
        except Exception:
            pass


def unchanged(records: DataFrame, source: Storage) -> DataFrame:
    """The records whose document is still the file that was read."""

    def run(batches: Iterator) -> Iterator:
        for rows in batches:
            now = [source.stamp(f"{p}/{d}") for p, d in zip(rows["source_path"], rows["doc_filename"], strict=True)]
            yield rows[[a == b for a, b in zip(now, rows["stamp"], strict=True)]][list(KEY)]

    same = records.select(*KEY, "stamp").mapInPandas(run, _KEYS)
    return records.join(same, list(KEY), "left_semi")


def _each(docs: DataFrame, call: Callable[[dict[str, Any]], None]) -> None:
    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for rows in batches:
            for doc in rows.to_dict("records"):
                call(doc)
            yield pd.DataFrame({"n": [len(rows)]})

    docs.select(*KEY).mapInPandas(run, "n long").agg(F.sum("n")).collect()
