"""Streaming jobs.

The operators are the batch ones applied to ``readStream`` input.  Tests and
registered queries drive them with ``trigger(availableNow=True)`` over the
driver's tables (a file stream of ``events`` rendered as lines); deployments
pass a message-topic source and a processing-time trigger.  Checkpoints and
output tables live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acctlens.config import AnalyzerConfig
from acctlens.operators import cause_mix as cm, outliers as ol
from acctlens.operators.first_order import ALIVE_AGG_NAME, agg_lines, alive_counts, stop_cause_counts
from acctlens.operators.ingest import parse_agg_line, parse_cdr
from acctlens.operators.moments import MOMENTS, batch_moments, beyond_sigmas, merged_moments
from acctlens.operators.second_order import second_order_stats
from acctlens.schema import INDEX_DOC_1_SCHEMA, INDEX_DOC_2_SCHEMA
from acctlens.sinks.committed import CommittedTable
from acctlens.sinks.documents import index_documents_1, index_documents_2
from acctlens.sinks.topics import head_sorted, write_topic
from acctlens.sources.events import event_lines_path
from acctlens.streaming.live import batch_anomalies, live_candidates, use_keyed_timers


def event_line_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table rendered as line files, read as a text stream."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(event_lines_path(spark, sf_dir))


def _trigger(writer, trigger_seconds: int | None):
    if trigger_seconds:
        return writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.trigger(availableNow=True)


def to_table(df: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = None,
             fmt: str = "parquet", name: str | None = None) -> StreamingQuery:
    """Append-mode file sink (exactly-once through the sink log)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger_seconds).start(path)


def with_batches(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                 trigger_seconds: int | None = None, name: str | None = None) -> StreamingQuery:
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(fn)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger_seconds).start()


def chained_stats(records: DataFrame, cfg: AnalyzerConfig) -> DataFrame:
    """Stage 1 (Alive counts) and stage 2 (mean/stdDev) in one streaming
    query - the intermediate topic hop of the reference becomes a chained
    stateful aggregation under one watermark."""
    first = alive_counts(records, cfg, streaming=True, keep_window=True)
    return second_order_stats(first, cfg, chained=True)


def hop_first_stage(records: DataFrame, cfg: AnalyzerConfig, path: str, checkpoint: str,
                    trigger_seconds: int | None = None) -> StreamingQuery:
    """Stage 1 published as aggregate lines (``name,ts,field,value``) to a
    line folder - the intermediate topic of the reference, as files."""
    lines = agg_lines(alive_counts(records, cfg, streaming=True)).select("value")
    return to_table(lines, path, checkpoint, trigger_seconds, fmt="text")


def hop_second_stage(agg_line_stream: DataFrame, cfg: AnalyzerConfig) -> DataFrame:
    """Stage 2 reading the aggregate lines back: parse, keep the Alive
    aggregate (the topic is multiplexed), watermark on its timestamp *after*
    the name filter, then the closed-form statistics."""
    first = parse_agg_line(agg_line_stream, 1).filter(F.col("aggName") == ALIVE_AGG_NAME)
    return second_order_stats(first, cfg, watermark_seconds=cfg.agg_watermark_seconds)


COUNTS_SCHEMA = "aggName string, timestamp timestamp, aggField1 string, value long"
STATS_SCHEMA = "aggName string, timestamp timestamp, aggField1 string, mean double, stdDev double, samples int"
ANOMALY_SCHEMA = ("aggName string, timestamp timestamp, aggField1 string, value long, statsTimestamp timestamp, "
                  "mean double, stdDev double")
PREDICTION_SCHEMA = "aggField1 string, prediction int, distanceFromCenter double"

#: The analyzer's tables: schema and event-time column.
OUTPUTS = {
    "agg_records": ("key string, value string", None),
    "agg_docs": (INDEX_DOC_1_SCHEMA, None),
    "counts": (COUNTS_SCHEMA, "timestamp"),
    "stats_docs": (INDEX_DOC_2_SCHEMA, None),
    "stats": (STATS_SCHEMA, "timestamp"),
    "anomalies": (ANOMALY_SCHEMA, "timestamp"),
    "cause_mix": ("aggField1 string, causeIndex int, cause string, ratioSum double, minSumPerBras long", None),
    "predictions": (PREDICTION_SCHEMA, None),
    "outliers": (PREDICTION_SCHEMA, None),
    "moments": (MOMENTS, None),
    "outliers_so_far": (PREDICTION_SCHEMA, None),
}


def output(spark: SparkSession, out_root: str, name: str) -> CommittedTable:
    schema, time = OUTPUTS[name]
    return CommittedTable(spark, f"{out_root}/{name}", schema, time, by_day=time is not None)


def alive_monitor_batch(out_root: str, topic: tuple[str, str] | None = None, show: int = 0) -> Callable[[DataFrame, int], None]:
    """Multi-output sink for stage-1 counts, per micro-batch: optional
    console head, message records (topic, or a table when no broker is
    configured), index documents and the counts themselves.  The batch is
    persisted once and released after.  Each table commits the batch for itself; a
    retry writes those that have not."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if show:
                head_sorted(batch, show, "timestamp", "aggField1").show(show, truncate=False)
            records = agg_lines(batch)
            if topic:
                write_topic(records, topic[0], topic[1])
            else:
                output(spark, out_root, "agg_records").write(records, batch_id)
            output(spark, out_root, "agg_docs").write(index_documents_1(batch), batch_id)
            output(spark, out_root, "counts").write(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def stats_batch(out_root: str, show: int = 0) -> Callable[[DataFrame, int], None]:
    """Stage-2 sink: the statistics by day and their index documents
    (``samples`` dropped)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if show:
                head_sorted(batch, show, "timestamp", "aggField1").show(show, truncate=False)
            output(spark, out_root, "stats_docs").write(index_documents_2(batch), batch_id)
            output(spark, out_root, "stats").write(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def anomaly_batch(cfg: AnalyzerConfig, out_root: str, show: int = 0) -> Callable[[DataFrame, int], None]:
    """Sink of the live check: what it finds, committed per micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        found = batch_anomalies(batch, cfg).persist()
        try:
            if show:
                head_sorted(found, show, "timestamp", "aggField1").show(show, truncate=False)
            output(batch.sparkSession, out_root, "anomalies").write(found, batch_id)
        finally:
            found.unpersist()

    return run


def bad_session_batch(cfg: AnalyzerConfig, out_root: str, labels: list[str] | None = None,
                      show: int = 0) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: ratios (batch scope), feature pipeline fitted on the
    batch (or fixed ``labels``), cause-mix vectors, k-means, distance to
    own centre and sigma outliers, each committed; a batch without rows, or with
    too few to cluster, commits empty ones.  The distances' moments are kept too, and
    ``outliers_so_far`` applies the sigma rule to those of all batches: a batch alone has
    one row a server, too few for a rule when there are few servers."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mix, predictions, outliers, moments, so_far = (
            output(spark, out_root, x) for x in ("cause_mix", "predictions", "outliers", "moments", "outliers_so_far"))

        def nothing(table: CommittedTable) -> None:
            table.write(spark.createDataFrame([], table.schema), batch_id)

        batch = batch.persist()
        try:
            if batch.isEmpty():
                for table in (mix, predictions, outliers, moments, so_far):
                    nothing(table)
                return
            ratios = cm.cause_ratio(batch, "batch")
            model = cm.fit_features(ratios, labels)
            feats = cm.cause_features(ratios, model, "batch").persist()
            try:
                if show:
                    head_sorted(feats, 30, "aggField1").show(30, truncate=False)
                mix.write(cm.features_long(feats, cm.model_labels(model), "batch"), batch_id)
                decorated, outl = ol.kmeans_outliers(feats, cfg.kmeans_k, cfg.kmeans_seed, cfg.outlier_sigmas)
                if decorated is None:
                    for table in (predictions, outliers, moments, so_far):
                        nothing(table)
                else:
                    predictions.write(decorated, batch_id)
                    outliers.write(outl, batch_id)
                    moments.write(batch_moments(decorated, "distanceFromCenter"), batch_id)
                    so_far.write(beyond_sigmas(decorated, merged_moments(moments.read()), cfg.outlier_sigmas), batch_id)
            finally:
                feats.unpersist()
        finally:
            batch.unpersist()

    return run


def run_analyzer(spark: SparkSession, lines: DataFrame, cfg: AnalyzerConfig, out_root: str,
                 trigger: bool = True, topic: tuple[str, str] | None = None, show: int = 0, fill: bool = False,
                 only: tuple[str, ...] = ("stats", "alive", "anomalies", "bad_sessions")) -> list[StreamingQuery]:
    """Both analyses on one line stream, as concurrent queries in one
    session: statistics with their documents, counts with theirs, the live anomaly
    check (``fill``: also of servers that fall silent) and the bad-session pattern.
    Returns the started queries; callers wait with
    ``spark.streams.awaitAnyTermination()``."""
    records = parse_cdr(lines)
    if fill and "anomalies" in only:
        use_keyed_timers(spark)
    jobs = {
        "stats": (lambda: chained_stats(records, cfg), stats_batch(out_root, show), cfg.bras_agg2_seconds),
        "alive": (lambda: alive_counts(records, cfg, streaming=True), alive_monitor_batch(out_root, topic, show), cfg.bras_agg1_seconds),
        "anomalies": (lambda: live_candidates(records, cfg, fill), anomaly_batch(cfg, out_root, show), cfg.bras_agg1_seconds),
        "bad_sessions": (lambda: stop_cause_counts(records, cfg, streaming=True), bad_session_batch(cfg, out_root), cfg.term_cause_agg1_seconds),
    }
    return [with_batches(frame(), sink, f"{out_root}/_ck/{name}", seconds if trigger else None, name=name)
            for name, (frame, sink, seconds) in jobs.items() if name in only]
