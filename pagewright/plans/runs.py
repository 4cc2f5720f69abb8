"""Whole runs: a normal one, one for metadata only, and the backfill of raw images."""

from __future__ import annotations

import hashlib
import logging
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.exprs import cached_rotation, is_pdf
from pagewright.operators import relational as R
from pagewright.operators.imaging import RECORDED, Options, Providers, extracted, with_raw_images
from pagewright.operators.outcomes import failure_text
from pagewright.schema import COMPLETED, DESCRIPTOR, FAILED, METADATA, PAGE, PAGES_CSV, SUBMISSIONS_CSV, TRANSFORMS, filled
from pagewright.settings import Settings, whole_or
from pagewright.sources import artifacts, descriptor, state, tables, versions
from pagewright.sources.discovery import discover
from pagewright.sources.journal import KEY, Journal, unchanged
from pagewright.sources.scratch import kept
from pagewright.sources.storage import Storage, open_side, reading
from pagewright.streaming.incremental import Stalled, watched

_READ = "submission_id string, source_path string, path string, content binary, error string"


def _read(found: DataFrame, storage: Storage, name: str) -> DataFrame:
    paths = found.select("submission_id", "source_path", F.concat_ws("/", "source_path", F.lit(name)).alias("path"))
    return paths.mapInPandas(reading(storage), _READ)


def _joined(prefix: str, name: str) -> str:
    return f"{prefix}/{name}" if prefix else name


def _target_path(prefix: str) -> Column:
    return F.concat_ws("/", *([F.lit(prefix)] if prefix else []), "submission_id")


def publish_metadata(found: DataFrame, source: Storage, target: Storage, settings: Settings, prefix: str) -> DataFrame:
    """Write metadata.json of each submission; what fails is told and harms nothing."""
    parsed = descriptor.parsed(_read(found, source, DESCRIPTOR)).filter("stage = ''")
    files = parsed.select(F.concat_ws("/", _target_path(prefix), F.lit(METADATA)).alias("path"), descriptor.metadata(F.col("text"), settings.salt).alias("text"))
    return artifacts.write_texts(files, target)


def dealt(df: DataFrame, each: int, least: int = 1) -> DataFrame:
    """``df`` in even parts of about ``each`` rows, but at least as many as run at once, or ``least``: what a lost task costs does not grow with the run."""
    n, least = df.count(), max(least, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(max(1, min(n, least), -(-n // each)))


def planned(work: DataFrame, source: Storage) -> tuple[DataFrame, DataFrame]:
    """The documents of ``work`` that are to be extracted, and the rows of what cannot be: bad descriptors, and ``broken`` rows that fail their whole submission."""
    parsed = kept(descriptor.parsed(_read(dealt(work, SUBMISSIONS), source, DESCRIPTOR)))
    caches = _read(dealt(work, SUBMISSIONS), source, TRANSFORMS).filter("error = ''").select("submission_id", F.decode("content", "UTF-8").alias("text"))
    docs = descriptor.documents(parsed)
    # a null extension fails its whole submission, without rows of pages
    broken = docs.filter("file_extension IS NULL").select("submission_id").distinct()
    fit = docs.join(broken, "submission_id", "left_anti").withColumn("pdf", is_pdf(F.col("file_extension"), F.col("mime_type")))
    done = descriptor.rotations(caches).groupBy("submission_id", "doc_filename").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("page_number").cast("string"), "applied"))), {"ignoreNullFields": "false"}).alias("cached")
    )
    ready = fit.join(done, ["submission_id", "doc_filename"], "left").select("submission_id", "source_path", "doc_filename", "position", "pdf", "cached")
    bad = parsed.filter("stage NOT IN ('', 'storage')").select(
        "submission_id", F.lit(DESCRIPTOR).alias("doc_filename"), F.lit(0).alias("position"), F.lit(1).alias("page_number"), F.lit(FAILED).alias("status"), failure_text(F.col("stage"), F.col("detail")).alias("error")
    )
    no_extension = broken.select("submission_id", failure_text(F.lit("extract"), F.lit("no file extension")).alias("error"))
    unopened = parsed.filter("stage = 'storage'").select("submission_id", failure_text(F.col("stage"), F.col("detail")).alias("error"))
    failed = no_extension.unionByName(unopened).withColumn("broken", F.lit(True))
    return kept(ready), bad.withColumn("broken", F.lit(False)).unionByName(failed, allowMissingColumns=True)


def told(pages: DataFrame, others: DataFrame) -> DataFrame:
    """All rows of a run: those of pages, with the stage in the errors of broken ones, and ``others`` of ``planned``."""
    error = F.when(F.col("broken"), failure_text(F.lit("extract"), F.col("error"))).otherwise(F.col("error"))
    return pages.withColumn("error", error).unionByName(others, allowMissingColumns=True)


def extract(work: DataFrame, source: Storage, target: Storage, providers: Providers, each: int = 50) -> DataFrame:
    """Page rows of all submissions of ``work``, failures of descriptors and documents among them; ``broken`` rows fail their whole submission, with their error."""
    ready, others = planned(work, source)
    return told(extracted(dealt(ready, each), providers, source, target).drop("image"), others)


#: Documents that one task extracts, and submissions whose descriptors one task reads, about.
DOCUMENTS, SUBMISSIONS = 50, 1000


def run(spark: SparkSession, settings: Settings, providers: Providers) -> dict[str, int]:
    """A run as the settings ask for; returns counts. Manifests are written last, and only if there was work.

    The settings reach the providers as options. Where no document is finished for as
    long as the settings allow, that is logged with the submissions in flight, and at last
    the extraction is ended: submissions of which all documents are finished are
    published, and Stalled is raised. What is finished stays in a journal until it is
    published, and a later run with the same options takes it from there; a forced run starts anew.
    """
    options = Options(settings.max_dimension, settings.text_threshold, settings.blank_threshold, settings.redetect_rotation)
    given = replace(providers, options=options)
    return backfill(spark, settings, given) if settings.backfill else _run(spark, settings, given)


def _journal(target: Storage, prefix: str, providers: Providers) -> Journal:
    key = hashlib.sha256(repr(providers.options).encode("utf-8")).hexdigest()[:12]
    return Journal(target, _joined(prefix, f"_journal/{key}"))


def _extracted(spark: SparkSession, settings: Settings, ready: DataFrame, providers: Providers, source: Storage, home: Storage, journal: Journal) -> tuple[DataFrame, DataFrame, Stalled | None]:
    """Pages of the documents of ``ready``, those documents that are not finished, and why."""

    def recorded() -> DataFrame:
        own = kept(journal.load(spark, RECORDED).join(ready.select(*KEY), list(KEY), "left_semi"))
        return kept(unchanged(own, source))

    def warn(seconds: float, ids: list[str]) -> None:
        logging.getLogger(__name__).warning("no result for %.0f s; in flight: %s", seconds, ", ".join(ids) or "nothing")

    journal.begin()
    earlier = recorded()
    todo = dealt(ready.join(earlier.select(*KEY), list(KEY), "left_anti"), DOCUMENTS, least=settings.parallelism)
    work = lambda: kept(extracted(todo, providers, source, home, journal=journal).drop("image"))
    try:
        fresh = watched(spark, work, whole_or(settings.stall_warning, 90), whole_or(settings.stall_timeout, 900), warn, progress=journal.progress)
        problem, left = None, ready.limit(0)
    except Stalled as stalled:
        problem, fresh, earlier = stalled, None, recorded()
        left = ready.join(earlier.select(*KEY), list(KEY), "left_anti")
    pages = earlier.select(F.inline("pages"))
    return pages if fresh is None else pages.unionByName(fresh), left, problem


def _publish(spark: SparkSession, settings: Settings, target: Storage, prefix: str, last: dict, submissions: DataFrame, pages: DataFrame) -> None:
    """Both manifests as the next version, and their rows as tables if the settings ask for that."""
    names: dict[str, str] = {}
    if settings.state:
        names = state.save_all(spark, settings.state, {"submissions": submissions, "pages": pages})
        submissions, pages = (spark.table(names[kind]) for kind in ("submissions", "pages"))
    manifests = {PAGES_CSV: (pages, ("submission_id", "doc_filename", "page_number")), SUBMISSIONS_CSV: (submissions, ("submission_id",))}
    try:
        versions.publish(spark, target, prefix, last["version"], manifests, names)
    except versions.Conflict:
        state.drop(spark, names)
        raise
    state.drop(spark, last.get("state"))


def _run(spark: SparkSession, settings: Settings, providers: Providers) -> dict[str, int]:
    source, source_prefix = open_side(settings.source)
    target, prefix = open_side(settings.target)
    source.probe_read()
    target.probe_write()
    found = discover(spark, source, source_prefix)
    if settings.metadata_only:
        told_files = publish_metadata(R.first_by_path(found, settings.max_submissions), source, target, settings, prefix)
        return {"submissions": told_files.count()}
    last = versions.latest(target, prefix)
    tabled = state.load(spark, last)
    old = tabled["submissions"] if tabled else tables.load_submissions(spark, target, prefix)
    queue = kept(R.first_by_path(R.work_queue(found, old, settings.force_reprocess), settings.max_submissions))
    if queue.isEmpty():
        return {"submissions": 0, "completed": 0, "failed": 0, "pages": 0}
    # of folders with one name the last by path is published
    asked = kept(R.last_by_path(queue))
    home = Storage(f"{target.root.rstrip('/')}/{prefix}", target.side) if prefix else target
    journal = _journal(target, prefix, providers)
    if settings.force_reprocess:
        journal.clear()
    ready, others = planned(asked, source)
    extracts, left, problem = _extracted(spark, settings, ready, providers, source, home, journal)
    unfinished = kept(left.select("submission_id").distinct())
    work = kept(asked.join(unfinished, "submission_id", "left_anti"))
    rows = kept(told(extracts, others).join(work.select("submission_id"), "submission_id", "left_semi"))
    failures = rows.filter("broken").groupBy("submission_id").agg(F.min("error").alias("error"))
    pages = rows.filter("NOT broken").join(failures, "submission_id", "left_anti")
    caches = artifacts.transform_caches(pages).join(work, "submission_id").select(F.concat_ws("/", "source_path", F.lit(TRANSFORMS)).alias("path"), "text")
    artifacts.write_texts(caches, source).count()
    publish_metadata(work.join(rows.filter("broken").select("submission_id"), "submission_id", "left_anti"), source, target, settings, prefix).count()
    broken = failures.select("submission_id", F.lit(FAILED).alias("status"), "error")
    whole = work.join(broken, "submission_id", "left_anti")
    new = kept(R.roll_up(whole, pages, ("position", "page_number")).unionByName(broken))
    if problem is None or not work.isEmpty():
        old_pages = tabled["pages"] if tabled else filled(tables.load_pages(spark, target, prefix), PAGE)
        carried = state.carried if tabled else R.carried
        _publish(spark, settings, target, prefix, last, R.published(carried(old, work), new), R.published(carried(old_pages, work), filled(pages, PAGE)))
        journal.forget(ready.join(work.select("submission_id"), "submission_id", "left_semi"))
    if problem is not None:
        raise problem
    counts = {r["status"]: r["n"] for r in R.status_counts(new).collect()}
    return {"submissions": sum(counts.values()), "completed": counts.get(COMPLETED, 0), "failed": counts.get(FAILED, 0), "pages": pages.count()}


def backfill(spark: SparkSession, settings: Settings, providers: Providers) -> dict[str, int]:
    """Make the raw images that completed pages lack; only the pages' manifest changes, and only if any was made."""
    source, source_prefix = open_side(settings.source)
    target, prefix = open_side(settings.target)
    source.probe_read()
    target.probe_write()
    last = versions.latest(target, prefix)
    pages = tables.load_pages(spark, target, prefix)
    wanted = R.first_ids(R.wants_raw_image(pages), settings.max_submissions)
    placed = R.with_source_path(wanted, discover(spark, source, source_prefix)).filter("NOT lost").drop("lost")
    sources = placed.select("submission_id", "source_path").distinct()
    docs = descriptor.documents(descriptor.parsed(_read(sources, source, DESCRIPTOR)))
    entries = docs.select("submission_id", "doc_filename", "position", is_pdf(F.col("file_extension"), F.col("mime_type")).alias("pdf"))
    caches = _read(sources, source, TRANSFORMS).filter("error = ''").select("submission_id", F.decode("content", "UTF-8").alias("text"))
    turned = descriptor.rotations(caches).select("submission_id", "doc_filename", "page_number", cached_rotation(F.col("applied")).alias("rotation"))
    ready = R.with_document(placed, entries).filter("pdf IS NOT NULL").join(turned, ["submission_id", "doc_filename", "page_number"], "left")
    own = [f.name for f in PAGE.fields]
    home = Storage(f"{target.root.rstrip('/')}/{prefix}", target.side) if prefix else target
    todo = kept(ready.select(*own, "_order", "source_path", "pdf", F.coalesce("rotation", F.lit(0)).alias("rotation")))
    made = kept(with_raw_images(dealt(todo, DOCUMENTS, least=settings.parallelism), providers, source, home))
    n = made.filter("raw_image_filename <> ''").count()
    if n:
        merged = R.upserted(pages.drop("_order"), made, order="_order")
        versions.publish(spark, target, prefix, last["version"], {PAGES_CSV: (kept(merged), ("submission_id", "doc_filename", "page_number"))})
        state.drop(spark, last.get("state"))
    return {"pages": n}
