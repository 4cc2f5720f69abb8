"""Descriptors of submissions: their documents, cached transforms and published metadata."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.schema import TRANSFORM_CACHE
from pagewright.sources.storage import NO_STORAGE

_ENTRY = "array<map<string,string>>"


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def parsed(descriptors: DataFrame) -> DataFrame:
    """``descriptors`` (submission_id, source_path, content, error) with text, user_email, files and what is wrong, as stage and detail.

    ``stage`` is storage (that does not open), descriptor (unreadable), parse (no JSON object) or ''.
    """
    text = F.decode("content", "UTF-8")
    out = descriptors.withColumn("text", F.when(F.col("error") == "", text))
    stage = F.when(F.col("error").startswith(NO_STORAGE), "storage").when(F.col("error") != "", "descriptor").when(~is_object(F.col("text")), "parse").otherwise("")
    return out.withColumns(
        {
            "stage": stage,
            "detail": F.when(stage == "storage", F.replace("error", F.lit(NO_STORAGE))).when(stage == "descriptor", F.col("error")).when(stage == "parse", "not a JSON object").otherwise(""),
            "version": F.coalesce(F.get_json_object("text", "$.version"), F.lit("")),
            "user": F.coalesce(F.get_json_object("text", "$.user"), F.lit("")),
            "user_email": F.get_json_object("text", "$.user.email"),
            "files": F.coalesce(F.from_json(F.get_json_object("text", "$.files"), _ENTRY), F.array().cast(_ENTRY)),
        }
    ).drop("content", "error")


def documents(parsed_: DataFrame) -> DataFrame:
    """A row for each entry of files: submission_id, source_path, position, doc_filename, file_extension, mime_type, extra.

    Absent strings are ''; an extension that is null stays null, as that fails the submission.
    """
    rows = parsed_.filter("stage = ''").select("submission_id", "source_path", F.posexplode("files").alias("position", "f"))
    known = ("stored_filename", "file_extension", "mime_type")
    extension = F.when(F.map_contains_key("f", "file_extension"), F.col("f")["file_extension"]).otherwise("")
    return rows.select(
        "submission_id",
        "source_path",
        "position",
        F.coalesce(F.col("f")["stored_filename"], F.lit("")).alias("doc_filename"),
        extension.alias("file_extension"),
        F.col("f")["mime_type"].alias("mime_type"),
        F.map_filter("f", lambda k, v: ~k.isin(*known)).alias("extra"),
    )


def rotations(caches: DataFrame) -> DataFrame:
    """Cached transforms, from rows of submission_id and text: submission_id, doc_filename, page_number, applied (maps of JSON texts). Bad caches give none."""
    cache = F.from_json("text", TRANSFORM_CACHE)
    by_doc = caches.select("submission_id", F.explode(cache).alias("doc_filename", "pages"))
    pages = by_doc.select("submission_id", "doc_filename", F.explode("pages").alias("page", "applied"))
    return pages.select("submission_id", "doc_filename", F.col("page").try_cast("int").alias("page_number"), "applied").filter("page_number IS NOT NULL")


def metadata_of(text: str, salt: str) -> str | None:
    """What is published of a descriptor, as JSON text with its own key order; None where it cannot be told.

    Only the form's metadata leave, and a salted hash of the address in place of it.
    """
    try:
        whole = json.loads(text)
        out = whole.get("form_metadata", {})
        if email := (whole.get("user") or {}).get("email"):
            out["submitter_fingerprint"] = hashlib.sha256((salt + email.strip().lower()).encode()).hexdigest()
        return json.dumps(out, ensure_ascii=False, indent=2)
    except Exception:
        return None


def metadata(text: Column, salt: str) -> Column:
    """``metadata_of`` over a column, in Arrow batches: JSON of any shape keeps its order and numbers only outside Spark's types."""

    @F.pandas_udf("string")
    def tell(texts):
        return texts.map(lambda t: None if t is None else metadata_of(t, salt))

    return tell(text)
