"""Small files that tasks write: metadata and caches, whole and idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.sources.storage import Storage

WRITTEN = "path string, error string"


def write_texts(df: DataFrame, storage: Storage) -> DataFrame:
    """Write the rows of ``df`` (path, text) and tell how each went; rows without text are left out."""

    def run(batches):
        import pandas as pd

        for rows in batches:
            out = []
            for path, text in zip(rows["path"], rows["text"], strict=True):
                try:
                    storage.write_text(path, text)
                    out.append((path, ""))
                except Exception as problem:
                    out.append((path, str(problem)))
            yield pd.DataFrame(out, columns=["path", "error"])

    return df.select("path", "text").filter(F.col("text").isNotNull()).mapInPandas(run, WRITTEN)


def transform_caches(pages: DataFrame) -> DataFrame:
    """submission_id and JSON text of the transforms applied to its pages, for those that have any.

    ``pages`` has submission_id, doc_filename, page_number and applied (JSON).
    """
    by_doc = pages.filter("applied IS NOT NULL").groupBy("submission_id", "doc_filename").agg(
        F.sort_array(F.collect_list(F.struct("page_number", "applied"))).alias("pages")
    )
    own = by_doc.groupBy("submission_id").agg(F.sort_array(F.collect_list(F.struct("doc_filename", "pages"))).alias("docs"))

    @F.pandas_udf("string")
    def told(docs):
        import json

        def one(entries) -> str:
            cache = {d["doc_filename"]: {str(p["page_number"]): [json.loads(p["applied"])] for p in d["pages"]} for d in entries}
            return json.dumps(cache, ensure_ascii=False, indent=2)

        return docs.map(one)

    return own.select("submission_id", told("docs").alias("text"))
