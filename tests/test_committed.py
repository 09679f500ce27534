"""Commit records: crash, retry, compaction, pruning."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from acctlens.session import scratch_path
from acctlens.sinks.committed import COMPACT, CommittedTable, Record
from acctlens.streaming import jobs

SCHEMA = "k string, t timestamp, v long"


def new(spark, time="t"):
    return CommittedTable(spark, scratch_path(spark, "test/committed", unique=True), SCHEMA, time)


def rows(spark, i, n=3):
    return spark.range(n).select(F.lit(f"b{i}").alias("k"), F.timestamp_seconds(F.lit(3600 * i)).alias("t"), F.col("id").alias("v"))


def test_records_are_names():
    r = Record(3, 5, 1, 10, -4, None, "abc")
    assert Record.parse(r.name) == r


def test_empty_table_and_empty_batch(spark):
    t = new(spark)
    assert t.read().count() == 0 and t.newest() is None
    assert t.write(rows(spark, 1, 0), 0)
    assert t.read().count() == 0 and t.read().columns == ["k", "t", "v"] and len(t.records()) == 1


def test_crash_between_write_and_commit_leaves_nothing_visible(spark, monkeypatch):
    t = new(spark)
    t.write(rows(spark, 1), 0)
    monkeypatch.setattr(t, "_commit", lambda record: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        t.write(rows(spark, 2), 1)
    monkeypatch.undo()
    assert len(t._names("data")) == 2 and t.read().count() == 3
    assert t.write(rows(spark, 2), 1)              # the retry
    assert t.read().count() == 6
    assert t.vacuum() == 1 and t.read().count() == 6


def test_a_committed_batch_is_not_written_again(spark):
    t = new(spark)
    assert t.write(rows(spark, 1), 7)
    assert not t.write(rows(spark, 2), 7)
    assert {r.k for r in t.read().collect()} == {"b1"}


def test_retry_of_a_compacted_batch(spark):
    t = new(spark)
    for i in range(4):
        t.write(rows(spark, i), i)
    t.compact(every=4)
    assert [(r.first, r.last, r.tier) for r in t.records()] == [(0, 3, 1)]
    t.vacuum()
    assert not t.write(rows(spark, 9), 2)
    assert t.read().count() == 12


def test_reads_open_only_batches_of_the_time(spark):
    t = new(spark)
    for i in range(6):
        t.write(rows(spark, 24 * i), i)
    got = t.read(dt.datetime(1970, 1, 3), dt.datetime(1970, 1, 4))
    assert got.count() == 6 and len(got.inputFiles()) <= 6 and all("1970-01-03" in f or "1970-01-04" in f for f in got.inputFiles())
    assert t.newest() == dt.datetime(1970, 1, 6)


def test_a_thousand_batches_are_few_files(spark, monkeypatch):
    """Records as a thousand batches leave them, each with its folder; compaction bounds what is read."""
    t = new(spark)
    monkeypatch.setattr(t, "compact", lambda: 0)
    for i in range(8):
        t.write(rows(spark, i), i)
    template = {r.first: r for r in t.records()}
    monkeypatch.undo()
    for i in range(8, 1000):  # the files of batch i % 8 again
        r = template[i % 8]
        shutil.copytree(t._data(r.folder), t._data(f"copy{i}"))
        t._commit(Record(i, i, 0, r.rows, r.low, r.high, f"copy{i}"))
    made = t.compact()
    live = t.records()
    assert made == 1000 // COMPACT and len(live) == made % COMPACT + 1000 % COMPACT
    got = t.read()
    assert got.count() == 3000
    assert len(got.inputFiles()) <= 3 * (1000 % COMPACT) + made
    assert got.groupBy("k").count().agg(F.sum("count")).first()[0] == 3000


def test_without_time_column(spark):
    t = new(spark, time=None)
    for i in range(3):
        t.write(rows(spark, i), i)
    t.compact(every=3)
    assert t.read().count() == 9 and t.newest() is None


def test_stream_that_dies_after_the_table_has_committed(spark, tmp_path):
    """The batch is run again from its checkpoint, state included, and not written twice."""
    spark.range(40).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("v")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    counts = stream.withWatermark("t", "1 second").groupBy(F.window("t", "10 seconds"), "k").agg(F.sum("v").alias("v"))
    out, died = new(spark), []

    def sink(batch, n):
        out.write(batch.select("k", F.col("window.end").alias("t"), "v"), n)
        if n == 1 and not died:
            died.append(n)
            raise RuntimeError("lost driver")

    for _ in range(2):
        q = counts.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(sink).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception as e:
            assert "lost driver" in str(e)
    assert died and sorted(r.v for r in out.read().collect()) == [45, 145, 245]


def test_a_batch_of_many_days_has_few_files_a_day(spark):
    """40 days in 8 pieces that each hold all of them; a single day is dealt over several writers."""
    t = CommittedTable(spark, scratch_path(spark, "test/committed", unique=True), SCHEMA, "t", by_day=True)
    days = spark.range(0, 4000, 1, 8).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 7919 % 40 * 86400).alias("t"), F.col("id").alias("v"))
    assert t.write(days, 0)
    got, writers = t.read(), spark.sparkContext.defaultParallelism
    assert len(got.inputFiles()) <= 40 + writers
    assert sorted(r.v for r in got.collect()) == list(range(4000))
    assert t.write(rows(spark, 0, 4000), 1) and t.write(rows(spark, 0, 0), 2)
    assert len(t._load([t.records()[1].folder]).inputFiles()) > 1 or writers == 1
    assert t.read().count() == 8000


def test_the_analyzers_tables_are_dealt_by_day(spark):
    assert {n for n in jobs.OUTPUTS if jobs.output(spark, "/tmp/none", n).by_day} == {"counts", "stats", "anomalies"}
