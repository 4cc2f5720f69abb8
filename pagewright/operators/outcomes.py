"""What went wrong, as rows: no failure of a record raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: how errors of each stage begin
STAGES = {
    "storage": "Storage init error: ",
    "descriptor": "Cannot read desc.json: ",
    "parse": "Cannot parse desc.json: ",
    "read": "Cannot read file: ",
    "open": "Failed to open PDF: ",
    "extract": "Page extraction error: ",
    "lines": "Line extraction error: ",
    "write": "Failed to write lines JSON: ",
}
NO_IMAGE = "image_filename is empty; cannot run line extraction"


def failure_text(stage: Column, detail: Column) -> Column:
    """The error of a record that failed in ``stage``; '' where there is no such stage."""
    out = F.lit("")
    for name, text in STAGES.items():
        out = F.when(stage == name, F.concat(F.lit(text), detail)).otherwise(out)
    return out
