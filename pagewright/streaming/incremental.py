"""Runs that follow a growing source, and the watch over results that stop coming."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagewright.functions.exprs import parent_id, parent_path
from pagewright.operators.relational import work_queue
from pagewright.schema import DESCRIPTOR


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 10_000) -> DataFrame:
    """A stream of the descriptors under ``folder``: submission_id, source_path, modified. Folders that begin with _ or . are not seen."""
    raw = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", DESCRIPTOR).option("maxFilesPerTrigger", files_per_trigger)
    stream = raw.schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return stream.select(parent_id(F.col("path")).alias("submission_id"), parent_path(F.col("path")).alias("source_path"), F.col("modificationTime").alias("modified"))


def follow(stream: DataFrame, manifest: Callable[[], DataFrame], process: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Process what has arrived and is not completed yet, then stop. Failed submissions come again only by a batch run."""

    def each(batch: DataFrame, _: int) -> None:
        process(work_queue(batch.dropDuplicates(["submission_id"]), manifest()))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stalls(results: DataFrame, warn: int = 90, abort: int = 900, mode: str = "append", timer: bool = False) -> DataFrame:
    """Of a stream of (run_id, ts): a row for each gap of at least ``warn`` seconds after a result, and one where it reaches ``abort``.

    With ``timer`` a gap is told when the clock reaches a limit, each limit once,
    else when the result after it comes. A run's last result is its state; late
    results older than it only confirm it.
    """

    def step(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        last, told = state.get if state.exists else (None, 0)
        out = []

        def tell(at: float) -> int:
            gap = at - last
            level = 2 if gap >= abort else 1 if gap >= warn else 0
            if level > told:
                out.append((key[0], at, int(gap), level == 2))
            return max(level, told)

        if state.hasTimedOut:
            told = tell(time.time())
        else:
            for at in sorted(pd.concat(list(frames))["at"]):
                if last is not None:
                    tell(at)
                if last is None or at > last:
                    last, told = at, 0
        state.update((last, told))
        if timer and told < 2:
            wait = last + (abort if told else warn) - time.time()
            state.setTimeoutDuration(max(1, int(wait * 1000) + 1))
        yield pd.DataFrame(out, columns=["run_id", "at", "gap", "aborts"])

    limit = GroupStateTimeout.ProcessingTimeTimeout if timer else GroupStateTimeout.NoTimeout
    seen = results.select("run_id", F.col("ts").cast("double").alias("at")).groupBy("run_id")
    found = seen.applyInPandasWithState(step, "run_id string, at double, gap long, aborts boolean", "last double, told long", mode, limit)
    return found.select("run_id", F.timestamp_seconds("at").alias("ts"), "gap", "aborts")


class Stalled(RuntimeError):
    """No result came for too long; ``in_flight`` is what was being worked on."""

    def __init__(self, text: str, in_flight: list[str]) -> None:
        super().__init__(text)
        self.in_flight = in_flight


#: A state that differs once a result has come, and the ids that are in flight.
Progress = Callable[[], tuple[object, list[str]]]


def watched(
    spark: SparkSession,
    work: Callable[[], object],
    warn: int | None,
    abort: int | None,
    on_warn: Callable[[float, list[str]], None] = lambda s, ids: None,
    poll: float = 10.0,
    progress: Progress | None = None,
) -> object:
    """``work()`` under a watch: a warning once for each time that no result comes for ``warn`` seconds, with what is in flight, and an end to it all after ``abort``.

    A result is what ``progress`` tells (see Journal.progress), or the end of a task:
    a long task that gets on is not idle. None switches a limit off. An ended job raises
    Stalled. The caller's job group is as it was before.
    """
    context, group = spark.sparkContext, f"watched-{time.time_ns()}"
    done, stalled, held = threading.Event(), threading.Event(), []
    own = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {name: context.getLocalProperty(name) for name in own}

    def infos() -> list:
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(group) if (job := tracker.getJobInfo(j)) for s in job.stageIds]
        return [info for s in stages if (info := tracker.getStageInfo(s))]

    def told() -> tuple[object, list[str]]:
        """What has come so far, and what is in flight."""
        running = infos()
        at = [f"{info.numActiveTasks} of {info.numTasks} tasks of {info.name}" for info in running if info.numCompletedTasks < info.numTasks]
        state, ids = progress() if progress else (None, [])
        return (sum(info.numCompletedTasks for info in running), state), ids or at

    def watch() -> None:
        seen, since, warned = None, time.monotonic(), False
        while not done.wait(poll):
            try:
                now, at = told()
            except Exception:  # what cannot be seen has not come
                now, at = seen, []
            if now != seen:
                seen, since, warned = now, time.monotonic(), False
            idle = time.monotonic() - since
            if warn is not None and idle >= warn and not warned:
                warned = True
                on_warn(idle, at)
            if abort is not None and idle >= abort:
                held.extend(at)
                stalled.set()
                context.cancelJobGroup(group)
                return

    watcher = threading.Thread(target=watch, daemon=True)
    context.setJobGroup(group, "watched run", interruptOnCancel=True)
    watcher.start()
    try:
        return work()
    except Exception as error:
        if stalled.is_set():
            raise Stalled(f"no worker result for {abort} s; in flight: {', '.join(held) or 'nothing'}", held) from error
        raise
    finally:
        done.set()
        watcher.join(poll + 5)
        for name, value in before.items():
            context.setLocalProperty(name, value)
