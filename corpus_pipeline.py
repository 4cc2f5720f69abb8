"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what is left, with the columns
of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.exact_dedup import drop_copies
from pagewright.llm.language_id import accepted
from pagewright.llm.mixing import mixed
from pagewright.llm.ngram_join import drop_near_copies
from pagewright.llm.packing import pack
from pagewright.llm.shared import documents, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their own labels teach."""
    return accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 or more."""
    return drop_near_copies(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place there."""
    return pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join), ("mixing", mixing), ("packing", packing)]

#: No SQL: models, rounded mixes and bin packing are not expressible; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
