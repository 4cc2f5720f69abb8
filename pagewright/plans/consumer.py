"""What consumers of a target read: its manifests with metadata and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.functions import exprs as E
from pagewright.schema import COMPLETED, LINES, METADATA
from pagewright.sources import tables
from pagewright.sources.storage import Storage, reading


def submissions(spark: SparkSession, target: Storage, prefix: str = "") -> DataFrame:
    """Submissions with their metadata as JSON text, {} where there is none."""
    rows = tables.load_submissions(spark, target, prefix)
    place = F.concat_ws("/", *([F.lit(prefix)] if prefix else []), "submission_id", F.lit(METADATA))
    read = rows.select("submission_id", place.alias("path")).mapInPandas(reading(target), "submission_id string, path string, content binary, error string")
    texts = read.select("submission_id", F.decode("content", "UTF-8").alias("metadata"))
    return rows.join(texts, "submission_id", "left").withColumn("metadata", F.coalesce("metadata", F.lit("{}")))


def pages(spark: SparkSession, target: Storage, prefix: str = "") -> DataFrame:
    return tables.load_pages(spark, target, prefix).drop("_order")


def lines(page_rows: DataFrame, target: Storage, prefix: str = "") -> DataFrame:
    """A row for each line of completed pages: submission_id, image_filename, sizes, index, bbox, polygon, confidence."""
    done = page_rows.filter((F.col("status") == COMPLETED) & (F.col("lines_filename") != ""))
    place = F.concat_ws("/", *([F.lit(prefix)] if prefix else []), "submission_id", "lines_filename")
    read = done.select(place.alias("path")).mapInPandas(reading(target), "path string, content binary, error string")
    return lines_of(read.filter("error = ''").select(F.decode("content", "UTF-8").alias("text")))


def lines_of(payloads: DataFrame) -> DataFrame:
    """A row for each line of lines files, from their ``text``."""
    whole = payloads.select(F.from_json("text", LINES).alias("l")).select("l.*")
    return whole.select("submission_id", "image_filename", "image_width", "image_height", "raw_image_width", "raw_image_height", F.inline("lines"))


def field(name: str) -> Column:
    """A metadata field of ``submissions``, as text."""
    return F.get_json_object("metadata", f"$.{name}")


def statistics(rows: DataFrame, name: str, averages: tuple[str, ...] = ()) -> DataFrame:
    """How often each value of a metadata field occurs among ``submissions``, and the averages of other fields over those where they are numbers."""
    return rows.groupBy(field(name).alias(name)).agg(F.count("*").alias("n"), *(F.avg(field(a).try_cast("double")).alias(a) for a in averages))


#: Rows of a tree that a task sorts, about.
TREE_ROWS = 250_000


def tree(subs: DataFrame, page_rows: DataFrame) -> DataFrame:
    """Submissions with their documents and pages, in the order of a tree: by submission, document and page number.

    ``label`` has the status and the short id. A submission without pages is a row
    of its own; pages of unknown submissions are left out. ``document`` and
    ``place`` number the documents of a submission and the pages of a document from 0.
    Tasks are as many as the rows ask for, and both numbers and the order come of one sort.
    """
    label = F.concat(F.lit("["), "status", F.lit("] "), E.short_id(F.col("submission_id").cast("string"))).alias("label")
    own = page_rows.select("submission_id", "doc_filename", F.col("page_number").cast("int").alias("page_number"), "image_filename", "lines_filename")
    docs = W.partitionBy("submission_id").orderBy("doc_filename")
    in_doc = W.partitionBy("submission_id", "doc_filename").orderBy("page_number", "image_filename")
    parts = -(-(subs.count() + page_rows.count()) // TREE_ROWS) or 1
    both = subs.select("submission_id", label).repartition(parts, "submission_id").join(own.repartition(parts, "submission_id"), "submission_id", "left")
    laid = both.repartitionByRange(parts, "submission_id").sortWithinPartitions("submission_id", "doc_filename", "page_number", "image_filename")
    there = F.col("doc_filename").isNotNull()
    return laid.withColumns({"document": F.when(there, F.dense_rank().over(docs) - 1), "place": F.when(there, F.row_number().over(in_doc) - 1)})


def training_rows(subs: DataFrame, page_rows: DataFrame, line_rows: DataFrame, fields: tuple[str, ...] = ()) -> DataFrame:
    """Lines of completed pages with their page and submission; boxes in pixels of the raw image.

    ``fields`` of the metadata become columns of their own, which are read once a
    submission and not once a line.
    """
    sx = F.when(F.col("image_width") > 0, F.col("raw_image_width") / F.col("image_width"))
    sy = F.when(F.col("image_height") > 0, F.col("raw_image_height") / F.col("image_height"))
    own = line_rows.withColumns({"raw_bbox": E.scaled(F.col("bbox"), sx, sy), "raw_polygon": E.scaled_points(F.col("polygon"), sx, sy)})
    done = page_rows.filter(F.col("status") == COMPLETED).select("submission_id", "image_filename", "doc_filename", "page_number")
    return own.join(done, ["submission_id", "image_filename"]).join(subs.select("submission_id", "metadata", *(field(f).alias(f) for f in fields)), "submission_id")


def line_at(line_rows: DataFrame, x: float, y: float) -> DataFrame:
    """For each image the first line that holds a point: in its polygon, or in its box where it has no polygon of four points; -1 if none does."""
    px, py = F.lit(float(x)), F.lit(float(y))
    polygon = E.four_points(F.col("polygon"))
    inside = F.when(F.size(polygon) == 4, E.in_polygon(polygon, px, py)).otherwise(F.coalesce(F.when(F.size("bbox") == 4, E.in_box(F.col("bbox"), px, py)), F.lit(False)))
    return line_rows.groupBy("submission_id", "image_filename").agg(F.coalesce(F.min(F.when(inside, F.col("index"))), F.lit(-1)).alias("index"))
