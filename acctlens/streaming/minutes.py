"""Continuous replay of minute folders.

Presence is a stream: the names of files that arrive (empty files count) or rows
of a minutes table.  Per leaf a small state
holds how far the replay has come and which minutes wait behind a gap.  A minute
is released when no gap of more than ``max_missing`` minutes lies before it; files
that arrive late fill gaps and release what waited.  Acceptance
only ever grows with further files, so the released minutes of a stream are, whatever
the order of arrival, those that the batch replay reads.

The lines of released minutes are read in the micro-batch and committed once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from acctlens.sinks.committed import CommittedTable
from acctlens.sources.minute_files import DEFAULT_MAX_MISSING, dated_lines, minute_paths, name_parts, parse_start_minute
from acctlens.streaming.jobs import with_batches
from acctlens.streaming.live import use_keyed_timers

RELEASED = "leaf string, minute timestamp, path string"
LINES = "leaf string, minute timestamp, value string"
EPOCH = dt.datetime(1970, 1, 1)
MINUTE = dt.timedelta(minutes=1)
BLOCK = 360  # minutes whose waiting paths are one entry of the state
NOTHING = np.array([], np.int64), np.array([], object)


class ReplayReach(StatefulProcessor):
    """Per leaf: the last minute reached, and the paths of minutes that wait.

    Those are kept by blocks of ``BLOCK`` minutes, each one entry of the state: a
    block is fetched or stored in one call, not minute by minute."""

    def __init__(self, start: dt.datetime, max_missing: int):
        self.start, self.step = (start - EPOCH) // MINUTE, max_missing + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reach = handle.getValueState("reach", "minute long, waiting long")
        self.waiting = handle.getMapState("waiting", "block long", "minutes array<long>, paths array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reach, blocks = self.reach.get() if self.reach.exists() else (self.start - 1, 0)
        new = pd.concat(rows)
        new = new[new["at"] >= self.start].assign(path=lambda x: x["path"].fillna("")).sort_values(["at", "path"])
        at, path = new["at"].to_numpy(np.int64), new["path"].to_numpy(object)
        late = np.searchsorted(at, reach, "right")
        if late:
            yield self._free(key, at[:late], path[:late])
        at, path = at[late:], path[late:]
        cuts = np.flatnonzero(np.diff(at // BLOCK)) + 1
        arrived = {int(a[0]) // BLOCK: (a, p) for a, p in zip(np.split(at, cuts), np.split(path, cuts)) if len(a)}
        block = (reach + 1) // BLOCK
        while (blocks or arrived) and block * BLOCK <= reach + self.step:  # what is in reach, in order of time
            at, path = arrived.pop(block, NOTHING)
            fresh, known = len(at) > 0, blocks > 0 and self.waiting.containsKey((block,))
            if known:
                at, path = self._joined(block, at, path)
            near = np.diff(at, prepend=reach) <= self.step
            n = len(at) if near.all() else int(near.argmin())
            if n:
                yield self._free(key, at[:n], path[:n])
                reach = int(at[n - 1])
            if n < len(at):  # a gap within the block: all that follows waits
                if n or fresh:
                    self._wait(block, at[n:], path[n:])
                blocks += not known
                break
            if known:
                self.waiting.removeKey((block,))
                blocks -= 1
            block += 1
        for block, (at, path) in arrived.items():
            known = blocks > 0 and self.waiting.containsKey((block,))
            if known:
                at, path = self._joined(block, at, path)
            self._wait(block, at, path)
            blocks += not known
        self.reach.update((reach, blocks))

    def _joined(self, block: int, at: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With what waits in the block already, by time."""
        minutes, paths = self.waiting.getValue((block,))
        at = np.concatenate([np.array(minutes, np.int64), at])
        order = np.argsort(at, kind="stable")
        return at[order], np.concatenate([np.array(paths, object), path])[order]

    def _wait(self, block: int, at: np.ndarray, path: np.ndarray) -> None:
        self.waiting.updateValue((block,), (at.tolist(), path.tolist()))

    @staticmethod
    def _free(key, at: np.ndarray, path: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"leaf": key[0], "at": at, "path": path})

    def close(self) -> None:
        pass


def note_arrivals(spark: SparkSession, root: str, noted: str) -> None:
    """Append the files of ``<root>/<leaf>/cdr.<minute>.txt`` that are not in the
    table ``noted`` yet, as one file, which appears at once: a call that is
    broken off and made again notes each file once.  A file stream over the folders
    would not do, since scans skip empty files."""
    try:
        known = spark.read.schema(RELEASED).parquet(noted)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], RELEASED)
    new = minute_paths(spark, root).filter("minute is not null").join(known.select("path"), "path", "left_anti")
    new.select("leaf", "minute", "path").coalesce(1).write.mode("append").parquet(noted)


def watch_folders(spark: SparkSession, root: str, noted: str, checkpoint: str, seconds: int) -> StreamingQuery:
    """:func:`note_arrivals` every ``seconds``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return with_batches(ticks, lambda batch, _: note_arrivals(batch.sparkSession, root, noted), checkpoint, seconds)


def file_presence(spark: SparkSession, noted: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """(leaf, minute, path) of noted files as they come."""
    reader = spark.readStream.schema(RELEASED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(noted)


def released_minutes(presence: DataFrame, start: str, max_missing: int = DEFAULT_MAX_MISSING) -> DataFrame:
    """(leaf, minute, path) that a replay from ``start`` may read, as a stream.
    Files without a minute in their name are left out."""
    at = F.floor(F.unix_seconds("minute") / 60).cast("long").alias("at")
    rows = presence.filter("minute is not null").select("leaf", at, F.col("path").cast("string").alias("path"))
    free = rows.groupBy("leaf").transformWithStateInPandas(ReplayReach(parse_start_minute(start), max_missing),
                                                           "leaf string, at long, path string", "append", "none")
    return free.select("leaf", F.timestamp_seconds(F.col("at") * 60).alias("minute"), "path")


def lines_of_files(batch: DataFrame) -> DataFrame:
    """The lines of a micro-batch's files; the driver holds the paths of one micro-batch, as the file source does."""
    paths = [r.path for r in batch.select("path").distinct().collect()]
    spark = batch.sparkSession
    if not paths:
        return spark.createDataFrame([], LINES)
    return spark.read.text(paths).select(*name_parts(F.col("_metadata.file_path")), "value")


def lines_of_table(root: str) -> Callable[[DataFrame], DataFrame]:
    """The lines of a micro-batch's minutes from ``<root>/lines/leaf=/day=``: days outside are not opened."""

    def read(batch: DataFrame) -> DataFrame:
        minutes = batch.select("leaf", "minute").distinct()
        first, last = minutes.agg(F.min(F.to_date("minute")), F.max(F.to_date("minute"))).first()
        if first is None:
            return batch.sparkSession.createDataFrame([], LINES)
        lines = dated_lines(batch.sparkSession, root, first).filter(F.col("day") <= F.lit(last))
        return lines.join(minutes, ["leaf", "minute"], "left_semi").select("leaf", "minute", "value")

    return read


def replay_stream(presence: DataFrame, start: str, out: CommittedTable, checkpoint: str,
                  lines: Callable[[DataFrame], DataFrame] = lines_of_files, max_missing: int = DEFAULT_MAX_MISSING,
                  trigger_seconds: int | None = None) -> StreamingQuery:
    """Replay continuously: lines of released minutes are committed to ``out``."""
    use_keyed_timers(presence.sparkSession)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            out.write(lines(batch), batch_id)
        finally:
            batch.unpersist()

    return with_batches(released_minutes(presence, start, max_missing), run, checkpoint, trigger_seconds)
