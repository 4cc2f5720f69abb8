"""Token totals that follow a corpus by signed deltas.

A ledger is a folder of batches. A batch holds the signed counts of the
documents that it inserts, deletes or revises, and their sums by source,
language and tokenizer version. It counts once its sums are complete, so a
batch that is sent again changes nothing, and totals are sums of sums. Batches
are merged into a base, which holds what counts and the ids of what it merged, so
that neither the work of a delete nor the number of folders grows with history.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty
from pagewright.llm.tokens import encoder, tokenizer_path

KEYS = ("source", "lang", "tokenizer")
COUNTS = ("documents", "characters", "tokens")


def _counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            texts = batch.column("text")
            tokens = pa.array([len(encode(t.as_py())) // 4 for t in texts], pa.int64())
            characters = pa.array([len(t.as_py()) for t in texts], pa.int64())
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), characters, tokens], names=[*keep, "characters", "tokens"])

    return run


def counted(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (doc_id, source, lang, text) with characters and tokens instead of text."""
    own = rows.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(_counting(path), f"doc_id {kind}, source string, lang string, characters long, tokens long")


class TokenLedger:
    """Totals of a corpus under one folder that all executors share.

    ``versions`` names tokenizer versions and their files. Changes are rows of op
    (insert, delete, revise), doc_id, text, source, lang; a delete needs only its
    doc_id. A null text counts as empty, null sources and languages are groups of
    their own, and rows of equal doc_id count each; a delete or revision takes back
    all that a doc_id counts so far. An empty batch commits and changes nothing; a
    batch with a null or unknown op is an error. Batches are committed one after
    another, by one writer: a delete takes back what earlier batches count.
    """

    def __init__(self, spark: SparkSession, folder: str, versions: dict[str, str] | None = None) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.versions = versions or {"word_bpe_49k": tokenizer_path()}

    def _path(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        at, files = self._path(path)
        return files.exists(at)

    def _folders(self, kind: str) -> list[str]:
        """What comes after ``kind`` in the names of folders, whole or not, in order."""
        at, files = self._path(self.folder)
        if not files.exists(at):
            return []
        names = [f.getPath().getName() for f in files.listStatus(at)]
        return sorted(n.removeprefix(kind) for n in names if n.startswith(kind))

    def _whole(self, kind: str) -> list[str]:
        return [n for n in self._folders(kind) if self._exists(f"{self.folder}/{kind}{n}/totals/_SUCCESS")]

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """The newest whole base, the ids that it merged, and the committed batches that it did not."""
        base = max(self._whole("base-"), key=int, default=None)
        merged = {r["batch"] for r in self.spark.read.parquet(f"{self.folder}/base-{base}/merged").collect()} if base else set()
        return base, merged, [b for b in self._whole("batch-") if b not in merged]

    def batches(self) -> list[str]:
        """Ids of the committed batches, merged ones too."""
        _, merged, since = self._state()
        return sorted([*merged, *since])

    def _read(self, part: str) -> DataFrame | None:
        base, _, since = self._state()
        paths = [f"{self.folder}/base-{base}/{part}"] * bool(base) + [f"{self.folder}/batch-{b}/{part}" for b in since]
        return self.spark.read.parquet(*paths) if paths else None

    def current(self) -> DataFrame | None:
        """What each doc_id counts now, where it counts anything."""
        rows = self._read("documents")
        if rows is None:
            return None
        return rows.groupBy("doc_id", *KEYS).agg(*(F.sum(c).alias(c) for c in COUNTS)).filter(" OR ".join(f"{c} <> 0" for c in COUNTS))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False and no change if it is there already. A batch that broke off is written anew."""
        to = f"{self.folder}/batch-{batch}"
        if batch in self.batches():
            return False
        unknown = changes.filter(F.col("op").isNull() | ~F.col("op").isin("insert", "delete", "revise")).select("op").first()
        if unknown:
            raise ValueError(f"unknown op {unknown['op']!r} in batch {batch!r}")
        arriving = changes.filter(F.col("op").isin("insert", "revise"))
        deltas = None
        for name, path in self.versions.items():
            new = counted(arriving, path).select("doc_id", "source", "lang", F.lit(name).alias("tokenizer"), F.lit(1).cast("long").alias("documents"), "characters", "tokens")
            deltas = new if deltas is None else deltas.unionByName(new)
        before = self.current()
        if before is not None:
            leaving = changes.filter(F.col("op").isin("delete", "revise")).select("doc_id").distinct()
            old = before.join(leaving, "doc_id", "left_semi").filter(F.col("tokenizer").isin(*self.versions))
            deltas = deltas.unionByName(old.select("doc_id", *KEYS, *((-F.col(c)).alias(c) for c in COUNTS)))
        self._put(to, deltas)
        return True

    def _put(self, to: str, deltas: DataFrame) -> None:
        """Rows and then their sums, whose completion makes the folder count."""
        deltas.write.mode("overwrite").parquet(f"{to}/documents")
        rows = self.spark.read.schema(deltas.schema).parquet(f"{to}/documents")
        rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in COUNTS)).write.mode("overwrite").parquet(f"{to}/totals")

    def compact(self) -> int:
        """Merge the base and the batches since it into a new base; how many batches that were, 0 and no change if none.

        The base holds one row for each doc_id, source, language and version that
        counts anything, rows of equal doc_id added up. Totals and ids of batches
        stay as they were, and a merged batch that is sent again still changes
        nothing. A merge that broke off does not count and is written anew. The
        writer of batches also merges; what was merged stays until ``clear``.
        """
        base, merged, since = self._state()
        if not since:
            return 0
        to = f"{self.folder}/base-{int(base or 0) + 1}"
        ids = self.spark.createDataFrame([(b,) for b in sorted([*merged, *since])], "batch string")
        ids.coalesce(1).write.mode("overwrite").parquet(f"{to}/merged")
        self._put(to, self.current())
        return len(since)

    def clear(self) -> int:
        """Delete merged batches and earlier bases, which no new reader opens; how many folders that were.

        Readers that began before the last merge must have ended.
        """
        base, merged, _ = self._state()
        old = [f"batch-{b}" for b in self._folders("batch-") if b in merged] + [f"base-{b}" for b in self._folders("base-") if base and int(b) < int(base)]
        for name in old:
            at, files = self._path(f"{self.folder}/{name}")
            files.delete(at, True)
        return len(old)

    def totals(self) -> DataFrame:
        """Sums by source, language and tokenizer version; groups that have come to nothing are left out."""
        sums = self._read("totals")
        if sums is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, documents long, characters long, tokens long")
        return sums.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in COUNTS)).filter("documents <> 0")
