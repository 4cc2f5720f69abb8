"""Work queues, carried rows, upserts and roll-ups, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.functions.exprs import error_text, or_else
from pagewright.schema import COMPLETED, FAILED, PAGE_KEY

def work_queue(found: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Found submissions that no manifest row calls completed; all of them if forced."""
    if force:
        return found
    done = manifest.filter(F.col("status") == COMPLETED).select("submission_id")
    return found.join(done, "submission_id", "left_anti")


def first_by_path(found: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` by path, compared part by part; all without a limit."""
    if n is None:
        return found
    return found.orderBy(F.split("source_path", "/"), "submission_id").limit(n)


def last_by_path(found: DataFrame) -> DataFrame:
    """submission_id and source_path, of folders with one id the last by path, compared part by part."""
    return found.groupBy("submission_id").agg(F.max_by("source_path", F.split("source_path", "/")).alias("source_path"))


def carried(manifest: DataFrame, work: DataFrame) -> DataFrame:
    """Manifest rows of submissions that are not worked on, also of those that have left the source."""
    return manifest.join(work.select("submission_id").distinct(), "submission_id", "left_anti")


def published(old: DataFrame, new: DataFrame) -> DataFrame:
    """Carried and new rows, duplicates kept."""
    return old.unionByName(new)


def in_flight(dispatched: DataFrame, collected: DataFrame, key: str = "submission_id") -> DataFrame:
    return dispatched.join(collected.select(key), key, "left_anti")


def last_wins(df: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key, by one aggregate with partial sums on the map side."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return picked.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest)).select(*df.columns)


def roll_up(work: DataFrame, pages: DataFrame, order: tuple[str, ...] = ("page_number",)) -> DataFrame:
    """Status and error of each submission of ``work`` from the statuses of its pages.

    All failed: failed, with their errors. Some failed: completed, with the names
    of those. None failed, or no page at all: completed.
    """
    failed = F.col("status") == FAILED
    by = F.struct(*order, "doc_filename", "image_filename", "error")
    named = F.sort_array(F.collect_list(F.when(failed, F.struct(by.alias("by"), or_else(F.col("image_filename"), F.col("doc_filename")).alias("name"), F.col("error").alias("error")))))
    sums = pages.groupBy("submission_id").agg(F.count("*").alias("n"), F.count_if(failed).alias("n_failed"), named.alias("bad"))
    every = (F.col("n") > 0) & (F.col("n") == F.col("n_failed"))
    errors = F.filter(F.transform("bad", lambda b: b["error"]), lambda e: e != "")
    names = F.concat(F.lit("Some pages failed: "), F.array_join(F.transform("bad", lambda b: b["name"]), ", "))
    return work.select("submission_id").join(sums, "submission_id", "left").select(
        "submission_id",
        F.when(every, FAILED).otherwise(COMPLETED).alias("status"),
        F.when(every, error_text(errors)).when(F.col("n_failed") > 0, names).otherwise("").alias("error"),
    )


def status_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("status").agg(F.count("*").alias("n"))


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("submission_id").agg(F.count("*").alias("pages"), F.count_if(F.col("status") == FAILED).alias("failed"))


def wants_raw_image(pages: DataFrame) -> DataFrame:
    """Completed pages with an image that lack the raw one."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return pages.filter((F.col("status") == COMPLETED) & ~empty("image_filename") & empty("raw_image_filename"))


def first_ids(pages: DataFrame, n: int | None, key: str = "submission_id") -> DataFrame:
    """The rows of the first ``n`` distinct ids in order."""
    if n is None:
        return pages
    return pages.join(pages.select(key).distinct().orderBy(key).limit(n), key, "left_semi")


def upserted(rows: DataFrame, updates: DataFrame, keys: tuple[str, ...] = PAGE_KEY, order: str | None = None) -> DataFrame:
    """``rows`` with those that ``updates`` has by key replaced whole; the number of rows stays. Of equal updates the last by ``order`` wins."""
    new = last_wins(updates, keys, order).drop(order) if order else updates
    own = [c for c in rows.columns if c not in keys]
    marked = new.select(*keys, F.struct(*own).alias("_new"))
    return rows.join(marked, list(keys), "left").select(*(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in rows.columns))


def with_source_path(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Pages with the path of their submission; ``lost`` marks those that have none."""
    paths = last_by_path(found)
    return pages.join(paths, "submission_id", "left").withColumn("lost", F.col("source_path").isNull())


def with_document(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Pages with the descriptor's entry of their document (submission_id, doc_filename, position and more); of equal names the last."""
    return pages.join(last_wins(documents, ("submission_id", "doc_filename"), "position"), ["submission_id", "doc_filename"], "left")


def colliding_names(images: DataFrame) -> DataFrame:
    """Image names that more than one page of a submission would write."""
    return images.groupBy("submission_id", "image_filename").agg(F.count("*").alias("n")).filter("n > 1")


def stall_gaps(events: DataFrame, warn: int = 90, abort: int = 900) -> DataFrame:
    """Whole seconds since the result before, where they reach ``warn``, and whether they reach ``abort``.

    Results are ordered within minutes; the first of a minute looks back to the last
    of the minute before it that has any. What is looked up is first ordered within
    days, so that no task orders more than the minutes of a day, or a row a day.
    """
    minute, day = F.date_trunc("minute", "ts").alias("minute"), F.to_date("minute").alias("day")
    minutes = events.groupBy(minute).agg(F.max("ts").alias("last")).withColumn("day", day)
    days = minutes.groupBy("day").agg(F.max("last").alias("end"))
    eves = days.select("day", F.lag("end").over(W.orderBy("day")).alias("eve"))  # a row a day
    earlier = F.lag("last").over(W.partitionBy("day").orderBy("minute"))
    before = minutes.join(eves, "day").select("minute", F.coalesce(earlier, F.col("eve")).alias("before"))
    order = W.partitionBy("minute").orderBy("ts", "event_id")
    watched = events.withColumn("minute", minute).join(before, "minute")
    previous = F.coalesce(F.lag("ts").over(order), F.col("before"))
    gaps = watched.withColumn("gap", F.timestamp_diff("SECOND", previous, F.col("ts"))).drop("minute", "before")
    return gaps.filter(F.col("gap") >= warn).withColumn("aborts", F.col("gap") >= abort)
