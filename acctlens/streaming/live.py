"""The live liveness check as one streaming query of bounded state.

counts (stage 1) --[zero windows of silent servers]--> judged counts
stats (stage 1 + stage 2, chained) ------------------^ interval join, newest match

Nothing that was written is read again: a count meets the statistics of its
lookback in a watermarked stream-stream join, and the watermark drops both sides'
rows as soon as no later row can need them.  State is bounded by the lookback and
the number of servers, input by what arrived since the last batch.

The newest match is picked within the micro-batch: one watermark closes a count
stamped T and all statistics stamped up to T, so whatever matches a count
comes out of the join in the batch that the count does.  (An aggregate behind the
join would hold each verdict back by the whole lookback, since the join's
output watermark lags by it.)
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from acctlens.config import AnalyzerConfig
from acctlens.operators.anomaly import lower_side_anomalies
from acctlens.operators.asof import time_bucket_of
from acctlens.operators.first_order import ALIVE_AGG_NAME, alive_counts
from acctlens.operators.second_order import second_order_stats

#: Event time of a count is the last microsecond of its window, as ``window_time`` has it.
FILLED_SCHEMA = "aggName string, timestamp timestamp, value long, aggField1 string, eventTime timestamp"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SilentWindows(StatefulProcessor):
    """Per server: the end of the next window that is due.  A count that is
    ahead of it, or a watermark that passes it, sends out the windows between
    with value 0.  A server is known from its first count on."""

    def __init__(self, slide_seconds: int, agg_name: str = ALIVE_AGG_NAME):
        self.slide, self.agg_name = slide_seconds * 1_000_000, agg_name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "us long")

    def _row(self, key, us: int, value: int) -> Row:
        return Row(aggName=self.agg_name, timestamp=_utc(us), value=value, aggField1=key[0], eventTime=_utc(us - 1))

    def _wait(self, old: int | None, due: int) -> None:
        if old != due:
            if old is not None:
                self.handle.deleteTimer(old // 1000)
            self.due.update((due,))
            self.handle.registerTimer(due // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = due = self.due.get()[0] if self.due.exists() else None
        for end, value in sorted((_micros(r.timestamp), r.value) for r in rows):
            for silent in range(due, end, self.slide) if due is not None else ():
                yield self._row(key, silent, 0)
            yield self._row(key, end, value)
            due = end + self.slide
        self._wait(old, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.due.exists():
            return
        due = old = self.due.get()[0]
        while due <= passed:
            yield self._row(key, due, 0)
            due += self.slide
        if due != old:
            self.due.update((due,))
            self.handle.registerTimer(due // 1000)

    def close(self) -> None:
        pass


def _utc(us: int):
    import datetime as dt

    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=us)


def _micros(t) -> int:
    """Epoch microseconds; a time without zone is in the worker's."""
    import datetime as dt

    return round((t.astimezone(dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))


def use_keyed_timers(spark: SparkSession) -> None:
    """Timers per key need the RocksDB state store; queries that are started after this use it."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB)


def live_counts(records: DataFrame, cfg: AnalyzerConfig, fill: bool = False) -> DataFrame:
    """Closed stage-1 counts with ``eventTime``; ``fill`` adds the zero
    windows of servers that send nothing, as the watermark passes them."""
    counts = alive_counts(records, cfg, streaming=True, keep_window=True).withColumn("eventTime", F.window_time("window"))
    counts = counts.select("aggName", "timestamp", "value", "aggField1", "eventTime")
    if not fill:
        return counts
    return counts.groupBy("aggField1").transformWithState(
        SilentWindows(cfg.bras_agg1_seconds), FILLED_SCHEMA, "append", "eventTime", eventTimeColumnName="eventTime")


def live_stats(records: DataFrame, cfg: AnalyzerConfig) -> DataFrame:
    """Closed stage-2 statistics with ``eventTime``."""
    first = alive_counts(records, cfg, streaming=True, keep_window=True)
    return second_order_stats(first, cfg, chained=True, keep_event_time=True)


def live_matches(counts: DataFrame, stats: DataFrame, cfg: AnalyzerConfig) -> DataFrame:
    """Each count with all statistics stamped in ``(timestamp - lookback,
    timestamp]``; counts without any are left out.

    Event times lie one microsecond before a count's stamp and two before that of
    statistics, hence the microsecond in the bounds.  The lookback is also the width of
    buckets of time, as in ``operators.asof``: each row of statistics goes to the two that its reach
    touches, so a count meets those of its bucket and not a server's whole batch."""
    width = cfg.lookback_seconds
    newest = F.col("eventTime") - F.expr("INTERVAL 1 MICROSECOND")
    reach_end = F.col("eventTime") + F.expr(f"INTERVAL {width} SECONDS") - F.expr("INTERVAL 1 MICROSECOND")
    reach = F.sequence(time_bucket_of(F.col("eventTime"), width), time_bucket_of(reach_end, width))
    s = stats.select(F.col("aggField1").alias("_key"), F.col("timestamp").alias("statsTimestamp"), "mean", "stdDev",
                     F.col("eventTime").alias("_statsTime"), F.explode(reach).alias("_reached"))
    counts = counts.withColumn("_bucket", time_bucket_of(newest, width))
    joined = counts.join(s, [counts["aggField1"] == s["_key"], F.col("_bucket") == F.col("_reached"), F.col("_statsTime") <= newest,
                             F.col("_statsTime") > newest - F.expr(f"INTERVAL {cfg.lookback_seconds} SECONDS")], "inner")
    return joined.select("aggName", "timestamp", "aggField1", "value", "statsTimestamp", "mean", "stdDev")


def live_candidates(records: DataFrame, cfg: AnalyzerConfig, fill: bool = False) -> DataFrame:
    """The streaming part of the check: counts with their lookback's statistics; with
    ``fill`` also zero windows of servers that went silent."""
    return live_matches(live_counts(records, cfg, fill), live_stats(records, cfg), cfg)


def batch_anomalies(candidates: DataFrame, cfg: AnalyzerConfig) -> DataFrame:
    """The rest, per micro-batch of candidates: the newest match of each count,
    and the counts far below it."""
    count = ["aggName", "timestamp", "aggField1", "value"]
    found = candidates.groupBy(*count).agg(F.max_by(F.struct("statsTimestamp", "mean", "stdDev"), "statsTimestamp").alias("s"))
    return lower_side_anomalies(found.select(*count, "s.statsTimestamp", "s.mean", "s.stdDev"), cfg.bras_std_dev_anomaly)
