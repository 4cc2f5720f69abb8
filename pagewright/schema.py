"""Types of the manifests and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPLETED, FAILED, PENDING = "completed", "failed", "pending"

# fixed values: files of a source tree and of a target
DESCRIPTOR = "desc.json"
TRANSFORMS = "transforms.json"
METADATA = "metadata.json"
SUBMISSIONS_CSV = "submissions.csv"
PAGES_CSV = "pages.csv"

SUBMISSION = T.StructType([T.StructField(n, T.StringType()) for n in ("submission_id", "status", "error")])
PAGE = T.StructType(
    [
        T.StructField("submission_id", T.StringType()),
        T.StructField("doc_filename", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("image_filename", T.StringType()),
        T.StructField("lines_filename", T.StringType()),
        T.StructField("raw_image_filename", T.StringType()),
        T.StructField("raw_image_width", T.IntegerType()),
        T.StructField("raw_image_height", T.IntegerType()),
    ]
)
PAGE_KEY = ("submission_id", "doc_filename", "page_number")
#: Columns that a manifest must have; the others default to '' or 0.
REQUIRED = {"submissions": ("submission_id", "status"), "pages": ("submission_id", "doc_filename", "page_number", "status")}

DOCUMENT = T.StructType([T.StructField(n, T.StringType()) for n in ("stored_filename", "file_extension", "mime_type")])
LINE = T.StructType(
    [
        T.StructField("index", T.IntegerType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("polygon", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("confidence", T.DoubleType()),
    ]
)
LINES = T.StructType(
    [
        T.StructField("submission_id", T.StringType()),
        T.StructField("image_filename", T.StringType()),
        T.StructField("image_width", T.IntegerType()),
        T.StructField("image_height", T.IntegerType()),
        T.StructField("raw_image_filename", T.StringType()),
        T.StructField("raw_image_width", T.IntegerType()),
        T.StructField("raw_image_height", T.IntegerType()),
        T.StructField("lines", T.ArrayType(LINE)),
    ]
)
#: What was done to an image, by name (rotation, original_size), as JSON texts: a null value differs from none.
APPLIED = T.MapType(T.StringType(), T.StringType())
TRANSFORM_CACHE = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(APPLIED)))


def filled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its order; nulls and absent columns become '' or 0."""

    def one(f: T.StructField) -> Column:
        empty = F.lit("" if isinstance(f.dataType, T.StringType) else 0).cast(f.dataType)
        return (F.coalesce(F.col(f.name).cast(f.dataType), empty) if f.name in df.columns else empty).alias(f.name)

    return df.select(*map(one, schema.fields))
