"""Late records as data, and what each micro-batch did.

A windowed stream drops a record whose windows have been closed, and only a counter
says so.  Here a stream is split before it is counted: by the watermark as of the
batch, records go to ``on_time`` or to ``late``, each committed once, and both
together are the input.  A record is late if the first of its windows to
close has been closed by what earlier batches held.

The watermark of a batch is itself committed first, so a batch that is retried is
split as before, and finding it reads one record, however long the stream runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from acctlens.sinks.committed import CommittedTable

MARKS = "batch long, watermark timestamp, seen timestamp"
PROGRESS = ("query string, batch long, watermark timestamp, inputRows long, droppedRows long, stateRows long, "
            "finished timestamp")


def first_window_end(time: Column, slide_seconds: int) -> Column:
    """End of the earliest sliding window (2 slides long) that holds ``time``: the next multiple of the slide."""
    us = slide_seconds * 1_000_000
    return F.timestamp_micros((F.floor(F.unix_micros(time) / us) + 1) * us)


class LateSplit:
    """Tables ``on_time``, ``late`` (record columns and the watermark they missed) and ``marks`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, time: str, slide_seconds: int, delay_seconds: int):
        self.time, self.slide, self.delay = time, slide_seconds, dt.timedelta(seconds=delay_seconds)
        self.on_time = CommittedTable(spark, f"{root}/on_time", schema, time)
        self.late = CommittedTable(spark, f"{root}/late", StructType(list(schema.fields)).add("watermark", "timestamp"), time)
        self.marks = CommittedTable(spark, f"{root}/marks", MARKS, "seen")

    def watermark(self, batch: DataFrame, batch_id: int) -> dt.datetime | None:
        """What earlier batches have seen less the delay; the batch's own records count from the next on."""
        seen = self.marks.newest()
        last = self.marks.read(since=seen).orderBy(F.desc("batch")).first() if seen else None
        if last is not None and last.batch >= batch_id:
            return last.watermark
        own = batch.agg(F.max(self.time)).first()[0]
        if own is not None or seen is not None:
            mark = None if seen is None else seen - self.delay
            self.marks.write(batch.sparkSession.createDataFrame([(batch_id, mark, max(t for t in (own, seen) if t))], self.marks.schema), batch_id)
        return None if seen is None else seen - self.delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            mark = self.watermark(batch, batch_id)
            limit = F.lit(mark).cast("timestamp")
            is_late = F.coalesce(first_window_end(F.col(self.time), self.slide) <= limit, F.lit(False))
            self.on_time.write(batch.filter(~is_late), batch_id)
            self.late.write(batch.filter(is_late).withColumn("watermark", limit), batch_id)
        finally:
            batch.unpersist()


class BatchLog(StreamingQueryListener):
    """Commits, for each micro-batch of the queries it is told of (all if none), its watermark, input rows,
    rows that stateful operators dropped as late, and rows in state.  Register it
    with ``spark.streams.addListener``."""

    def __init__(self, table: CommittedTable, names: tuple[str, ...] = ()):
        self.table, self.names, self.turn = table, names, None

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.names and p.name not in self.names:
            return
        mark = p.eventTime.get("watermark")
        at = lambda s: dt.datetime.fromisoformat(s.replace("Z", "+00:00")).astimezone().replace(tzinfo=None)
        row = (p.name, p.batchId, at(mark) if mark else None, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               sum(s.numRowsTotal for s in p.stateOperators), at(p.timestamp))
        if self.turn is None:
            self.turn = max((r.last for r in self.table.records()), default=-1)
        self.turn += 1
        self.table.write(self.table.spark.createDataFrame([row], self.table.schema), self.turn)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def batch_log(spark: SparkSession, path: str) -> CommittedTable:
    return CommittedTable(spark, path, PROGRESS, "finished")
