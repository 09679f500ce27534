"""Streams equal batches on closed windows (availableNow file streams)."""

import datetime as dt

from pyspark.sql import functions as F

from acctlens.operators.first_order import alive_counts
from acctlens.operators.ingest import parse_cdr
from acctlens.operators.second_order import second_order_stats
from acctlens.plans.common import CFG, records
from acctlens.session import scratch_path
from acctlens.streaming import jobs
from tests.conftest import SF_SMALL


def _watermark(spark, seconds):
    mx = records(spark, SF_SMALL).agg(F.max("date")).first()[0]
    return mx - dt.timedelta(seconds=seconds)


def test_stream_alive_equals_batch(spark):
    root = scratch_path(spark, "test/stream_alive", unique=True)
    stream = alive_counts(parse_cdr(jobs.event_line_stream(spark, SF_SMALL)), CFG, streaming=True)
    jobs.to_table(stream, f"{root}/out", f"{root}/_ck").awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    batch = alive_counts(records(spark, SF_SMALL), CFG).filter(
        F.col("timestamp") <= F.lit(_watermark(spark, CFG.alive_watermark_seconds)))
    assert got.count() == batch.count() > 0
    assert batch.exceptAll(got.select(*batch.columns)).count() == 0


def test_chained_stats_equal_batch(spark):
    root = scratch_path(spark, "test/stream_chain", unique=True)
    stream = jobs.chained_stats(parse_cdr(jobs.event_line_stream(spark, SF_SMALL)), CFG)
    jobs.to_table(stream, f"{root}/out", f"{root}/_ck").awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    batch = second_order_stats(alive_counts(records(spark, SF_SMALL), CFG), CFG).filter(
        F.col("timestamp") <= F.lit(_watermark(spark, CFG.alive_watermark_seconds)))
    assert got.count() == batch.count() > 0
    assert batch.exceptAll(got.select(*batch.columns)).count() == 0


def test_batch_sink_is_idempotent(spark):
    from acctlens.sinks.topics import write_batch_table
    path = scratch_path(spark, "test/idempotent", unique=True)
    df = spark.range(5)
    write_batch_table(df, path, 1)
    write_batch_table(df, path, 1)       # replayed batch
    write_batch_table(df, path, 2)
    assert spark.read.parquet(path).count() == 10


def test_run_analyzer_concurrent_queries(spark):
    root = scratch_path(spark, "test/analyzer", unique=True)
    queries = jobs.run_analyzer(spark, jobs.event_line_stream(spark, SF_SMALL), CFG, root, trigger=False)
    assert len(queries) == 4
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    for name in ("stats", "agg_docs", "cause_mix", "counts", "predictions"):
        assert jobs.output(spark, root, name).read().count() > 0
