"""Late rows: split, retry, and what the log says of each batch."""

import datetime as dt
import time

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acctlens.session import scratch_path
from acctlens.streaming import jobs
from acctlens.streaming.late import BatchLog, LateSplit, batch_log, first_window_end

SCHEMA = StructType().add("k", "string").add("t", "timestamp")
T0 = dt.datetime(2024, 1, 1)


def at(*seconds):
    return [("x", T0 + dt.timedelta(seconds=s)) for s in seconds]


def seconds(df):
    return sorted(None if r.t is None else (r.t - T0).total_seconds() for r in df.collect())


def split(spark, root=None):
    return LateSplit(spark, root or scratch_path(spark, "test/late", unique=True), SCHEMA, "t", 5, 3)


def test_first_window_end(spark):
    got = spark.createDataFrame(at(0, 4.9, 5), SCHEMA).select(first_window_end(F.col("t"), 5).alias("t"))
    assert seconds(got) == [5, 5, 10]


def test_rows_are_split_by_what_earlier_batches_saw(spark):
    """Delay 3, slide 5: after 20 the watermark is 17, windows up to 15 are closed; a batch never judges itself."""
    s = split(spark)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    s(frame([]), 0)
    s(frame(at(20, 1)), 1)
    s(frame(at(9, 14, 15, 16, 30) + [("n", None)]), 2)
    s(frame([]), 3)
    s(frame(at(24, 25)), 4)
    assert seconds(s.late.read()) == [9, 14, 24]
    assert sorted(seconds(s.on_time.read().filter("t is not null"))) == [1, 15, 16, 20, 25, 30]
    assert s.on_time.read().filter("t is null").count() == 1
    assert {(r.watermark - T0).total_seconds() for r in s.late.read().collect()} == {17, 27}


def test_retry_after_a_crash_between_the_tables(spark, monkeypatch):
    s = split(spark)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    s(frame(at(20)), 0)
    monkeypatch.setattr(s.late, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    try:
        s(frame(at(9, 100)), 1)
    except RuntimeError:
        pass
    monkeypatch.undo()
    again = split(spark, s.on_time.path.rsplit("/", 1)[0])
    again(frame(at(9, 100)), 1)       # 100 was seen by batch 1 itself, so 9 is judged as before
    assert seconds(again.on_time.read()) == [20, 100] and seconds(again.late.read()) == [9]
    again(frame(at(99)), 2)
    assert seconds(again.late.read()) == [9] and seconds(again.on_time.read()) == [20, 99, 100]


def test_split_rows_are_what_the_windowed_count_keeps(spark, tmp_path):
    """The counts of on-time records, streamed, drop nothing; the log has every batch."""
    folder = str(tmp_path / "in")
    for n, rows in enumerate([at(*range(0, 40)), at(*range(10, 60)), at(*range(30, 90, 2)), at(*range(0, 100, 5))]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    log = batch_log(spark, str(tmp_path / "log"))
    listener = BatchLog(log, ("late_test",))
    spark.streams.addListener(listener)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    counts = stream.withWatermark("t", "3 seconds").groupBy(F.window("t", "10 seconds", "5 seconds")).count()
    jobs.with_batches(counts, lambda b, n: b.write.format("noop").mode("overwrite").save(), str(tmp_path / "ck0"), name="late_test").awaitTermination()
    s = split(spark, str(tmp_path / "out"))
    jobs.with_batches(stream, s, str(tmp_path / "ck1")).awaitTermination()
    late, on_time = s.late.read(), s.on_time.read()
    everything = spark.read.parquet(folder)
    assert late.count() > 0 and seconds(late.select("k", "t").union(on_time)) == seconds(everything)
    deadline = time.time() + 20
    while time.time() < deadline and (log.read().agg(F.sum("inputRows")).first()[0] or 0) < everything.count():
        time.sleep(0.5)
    spark.streams.removeListener(listener)
    rows = log.read().collect()
    assert sum(r.inputRows for r in rows) == everything.count() and sum(r.droppedRows for r in rows) > 0
    assert {r.query for r in rows} == {"late_test"} and any(r.watermark for r in rows)
