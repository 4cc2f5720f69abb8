"""Manifests as CSV: one file, a header always, quotes doubled, read by column name."""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators.relational import last_wins
from pagewright.schema import PAGE, PAGES_CSV, REQUIRED, SUBMISSION, SUBMISSIONS_CSV, filled
from pagewright.sources.storage import Storage

_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}


def read_manifest(spark: SparkSession, path: str, kind: str, there: bool) -> DataFrame:
    """Rows of a manifest by column name, in file order as ``_order``; none if it is not ``there``.

    Optional columns that an older file lacks are '' or 0. A missing required one
    raises, and so does a page number that is none.
    """
    schema = SUBMISSION if kind == "submissions" else PAGE
    if not there:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_order", T.LongType())]))
    raw = spark.read.options(header="true", multiLine="true", **_DIALECT).csv(path)
    missing = [c for c in REQUIRED[kind] if c not in raw.columns]
    if missing:
        raise KeyError(f"{path} lacks {', '.join(missing)}")
    numbers = {f.name for f in schema.fields if isinstance(f.dataType, T.IntegerType)} - {"page_number"}
    blank = {c: F.nullif(F.trim(c), F.lit("")) for c in numbers & set(raw.columns)}
    ordered = raw.withColumn("_order", F.monotonically_increasing_id()).withColumns(blank)
    return filled(ordered, T.StructType([*schema.fields, T.StructField("_order", T.LongType())]))


def _at(prefix: str, name: str) -> str:
    return f"{prefix}/{name}" if prefix else name


def load_submissions(spark: SparkSession, storage: Storage, prefix: str = "") -> DataFrame:
    """The last row of each submission."""
    path = _at(prefix, SUBMISSIONS_CSV)
    storage.prepare(spark)
    return last_wins(read_manifest(spark, storage.uri(path), "submissions", storage.exists(path)), ("submission_id",), "_order").drop("_order")


def load_pages(spark: SparkSession, storage: Storage, prefix: str = "") -> DataFrame:
    """All rows, equal keys too, with their order in the file as ``_order``."""
    path = _at(prefix, PAGES_CSV)
    storage.prepare(spark)
    return read_manifest(spark, storage.uri(path), "pages", storage.exists(path))


def stage_manifest(df: DataFrame, storage: Storage, path: str, keys: tuple[str, ...]) -> str:
    """Write ``df`` sorted by ``keys`` as one CSV file in the folder ``path``, and give the file's path.

    Tasks sort and write parts. One file is the format, so one task then strings
    the bytes of the parts together, without looking into them; nothing goes
    through the driver. Each attempt of that task writes a file of its own.
    """
    spark, parts = df.sparkSession, f"{path}/parts"
    storage.prepare(spark)
    df.orderBy(*keys).write.options(header="false", emptyValue="", nullValue="", **_DIALECT).csv(storage.uri(parts))
    names = list(df.columns)

    def joined(batches):
        import pandas as pd

        for rows in batches:
            staged = f"{path}/whole-{uuid.uuid4().hex}"
            if len(rows):
                fs, head = storage._open(), io.StringIO()
                csv.writer(head, lineterminator="\n").writerow(names)
                with fs.open_output_stream(storage.absolute(staged)) as out:
                    out.write(head.getvalue().encode("utf-8"))
                    for part in sorted(storage.list_files(parts), key=part_number):
                        if part_number(part) >= 0:
                            with fs.open_input_stream(storage.absolute(part)) as content:
                                while chunk := content.read(8_000_000):
                                    out.write(chunk)
            yield pd.DataFrame({"path": [staged] * len(rows)})

    return spark.range(1).coalesce(1).mapInPandas(joined, "path string").first()["path"]


def part_number(path: str) -> int:
    """The number of a part that a writer of Spark's made, by which parts are in order; -1 for other files."""
    name = path.rsplit("/", 1)[-1].split("-")
    return int(name[1]) if name[0] == "part" and len(name) > 1 and name[1].isdigit() else -1


def save_manifest(df: DataFrame, storage: Storage, path: str, keys: tuple[str, ...]) -> None:
    """Write ``df`` sorted by ``keys`` as one CSV file of exactly this path, which is replaced only when the new one is whole."""
    folder = f"{path}.{uuid.uuid4().hex}"
    storage.move(stage_manifest(df, storage, folder, keys), path)
    storage.delete_folder(folder)
