"""The live check, silent servers, streamed minute folders, restart."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from acctlens.config import AnalyzerConfig
from acctlens.operators.first_order import alive_counts
from acctlens.operators.ingest import parse_cdr
from acctlens.session import scratch_path
from acctlens.sinks.committed import CommittedTable
from acctlens.sources.minute_files import minute_file_lines
from acctlens.streaming import jobs
from acctlens.streaming.live import STATE_PROVIDER, live_counts, use_keyed_timers
from acctlens.streaming.minutes import LINES, file_presence, note_arrivals, replay_stream, watch_folders

CFG = AnalyzerConfig()
START = dt.datetime(2024, 1, 1)


def line(at, server, status="Alive"):
    fields = [at.strftime("%Y/%m/%d %H:%M:%S"), "1", status, "S", "1"] + ["0"] * 6 + [f"n{server}", f"10.0.0.{server}"] + ["1"] * 15
    return ",".join(fields)


def write_file(folder, n, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{n:04d}.txt"
    with open(path, "w") as f:
        f.write("\n".join(lines))
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


@pytest.fixture
def few_partitions(spark):
    """Small state: one partition, and the store that was set before."""
    old, n = spark.conf.get(STATE_PROVIDER), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set(STATE_PROVIDER, old)


def test_zero_windows_follow_the_watermark(spark, tmp_path, few_partitions):
    """Server 2 stops after 100 s; server 1 goes on and moves the watermark; server 3 begins
    late and is silent for a while in between."""
    at = lambda s: START + dt.timedelta(seconds=s)
    folder = str(tmp_path / "lines")
    for n in range(6):
        span = range(60 * n, 60 * n + 60)
        write_file(folder, n, [line(at(s), 1) for s in span] + [line(at(s), 2) for s in span if s < 100]
                   + [line(at(s), 3) for s in span if 150 <= s < 170 or s >= 300])
    use_keyed_timers(spark)
    records = parse_cdr(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder))
    jobs.to_table(live_counts(records, CFG, fill=True), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {(r.aggField1[-1], int((r.timestamp - START).total_seconds())): r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    closed = 359 - CFG.alive_watermark_seconds          # the final watermark
    want = {}
    for server, alive in (("1", lambda s: s < 360), ("2", lambda s: s < 100), ("3", lambda s: 150 <= s < 170 or 300 <= s < 360)):
        ends = [e for e in range(5, 400, 5) if e <= closed]
        counts = {e: sum(alive(s) for s in range(max(0, e - 10), e)) for e in ends}
        first = min(e for e in ends if counts[e])
        want |= {(server, e): counts[e] for e in ends if e >= first}
    assert got == want
    assert got[("2", 300)] == 0 and got[("3", 250)] == 0


def test_live_input_and_state_stay_flat_over_fifty_batches(spark, tmp_path, few_partitions):
    """Each batch reads what arrived and no more, and state keeps to the lookback."""
    folder, n_files = str(tmp_path / "lines"), 50
    for n in range(n_files):
        write_file(folder, n, [line(START + dt.timedelta(seconds=60 * n + s), k) for s in range(60) for k in (1, 2)])
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    (query,) = jobs.run_analyzer(spark, lines, CFG, str(tmp_path / "out"), trigger=False, only=("anomalies",))
    seen = {}
    while query.isActive:
        seen |= {p.batchId: p for p in query.recentProgress}
        query.awaitTermination(1)
    seen |= {p.batchId: p for p in query.recentProgress}
    assert query.exception() is None
    read = [p.numInputRows for _, p in sorted(seen.items()) if p.numInputRows]
    assert len(read) >= n_files - 2 and max(read) == min(read) <= 4 * 120
    state = [sum(s.numRowsTotal for s in p.stateOperators) for _, p in sorted(seen.items())]
    assert max(state[25:]) <= 1.2 * max(state[10:25])


def test_alarm_of_a_server_that_falls_silent(spark, tmp_path, few_partitions):
    """Server 2 stops for good: its zero windows are flagged while its statistics last."""
    folder, stop = str(tmp_path / "lines"), 300
    for n in range(10):
        write_file(folder, n, [line(START + dt.timedelta(seconds=60 * n + s), k) for s in range(60) for k in (1, 2) if k == 1 or 60 * n + s < stop])
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 2).load(folder)
    (query,) = jobs.run_analyzer(spark, lines, CFG, str(tmp_path / "out"), trigger=False, only=("anomalies",), fill=True)
    query.awaitTermination()
    got = jobs.output(spark, str(tmp_path / "out"), "anomalies").read().collect()
    assert got and {r.aggField1 for r in got} == {"10.0.0.2"} and {r.value for r in got} <= {0, 5}
    times = [(r.timestamp - START).total_seconds() for r in got]
    assert min(times) >= stop and max(times) <= stop + 60 + CFG.lookback_seconds


def minute_folders(root, files):
    for leaf, minute, content in files:
        os.makedirs(f"{root}/{leaf}", exist_ok=True)
        with open(f"{root}/{leaf}/cdr.{minute.strftime('%Y-%m-%dT%H-%M')}.txt", "w") as f:
            f.write(content)


def test_streamed_minute_folders_equal_the_batch(spark, tmp_path, few_partitions):
    """Leaf a has a long gap that a late empty file bridges, b one that nothing does, c starts too late."""
    at = lambda m: START + dt.timedelta(minutes=m)
    root, waves = str(tmp_path / "in"), [
        [("a", at(m), f"a{m}\nsecond") for m in (-5, 0, 1, 3)] + [("b", at(m), f"b{m}") for m in (2, 4)],
        [("a", at(m), f"a{m}") for m in (30, 31, 52, 53)] + [("b", at(30), "b30"), ("c", at(40), "c40")],
        [("a", at(20), "")],
        [("a", at(2), "a2 late"), ("b", at(5), "b5")]]
    out = CommittedTable(spark, str(tmp_path / "out"), LINES, "minute")
    start = START.strftime("%Y-%m-%dT%H-%M")
    for wave in waves:      # each wave is a run that starts again from the checkpoint
        minute_folders(root, wave)
        note_arrivals(spark, root, str(tmp_path / "noted"))
        note_arrivals(spark, root, str(tmp_path / "noted"))     # once more: nothing is noted twice
        replay_stream(file_presence(spark, str(tmp_path / "noted")), start, out, str(tmp_path / "ck")).awaitTermination()
    want = minute_file_lines(spark, root, start, "reference")
    rows = lambda df: sorted((r.leaf, r.minute, r.value) for r in df.select("leaf", "minute", "value").collect())
    got = rows(out.read())
    assert got == rows(want)
    assert {v for _, _, v in got} == {"a0", "second", "a1", "a3", "a30", "a31", "a52", "a53", "a2 late", "b2", "b4", "b5"}


def test_watched_folders_are_noted(spark, tmp_path):
    minute_folders(str(tmp_path / "in"), [("a", START, "x"), ("b", START, "")])
    q = watch_folders(spark, str(tmp_path / "in"), str(tmp_path / "noted"), str(tmp_path / "ck"), 1)
    while q.isActive and (q.lastProgress is None or q.lastProgress.batchId < 2):
        q.awaitTermination(0.2)
    q.stop()
    assert sorted(r.leaf for r in spark.read.parquet(str(tmp_path / "noted")).collect()) == ["a", "b"]


def test_restart_from_checkpoint_gives_each_window_once(spark, tmp_path):
    """Stopped in the middle on a processing-time trigger; state and offsets come back."""
    folder = str(tmp_path / "lines")
    for n in range(8):
        write_file(folder, n, [line(START + dt.timedelta(seconds=20 * n + s), s % 3) for s in range(20)])
    out = CommittedTable(spark, str(tmp_path / "out"), jobs.COUNTS_SCHEMA, "timestamp")
    counts = alive_counts(parse_cdr(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)), CFG, streaming=True)
    for last in (False, True):
        q = jobs.with_batches(counts, lambda b, n: out.write(b, n) and None, str(tmp_path / "ck"), trigger_seconds=1)
        if last:
            q.processAllAvailable()
        else:
            while q.isActive and (q.lastProgress is None or q.lastProgress.batchId < 3):
                q.awaitTermination(0.1)
        q.stop()
        assert q.exception() is None
    closed = START + dt.timedelta(seconds=159 - CFG.alive_watermark_seconds)
    want = alive_counts(parse_cdr(spark.read.text(folder)), CFG).filter(F.col("timestamp") <= F.lit(closed))
    key = lambda df: sorted((r.aggField1, r.timestamp, r.value) for r in df.collect())
    assert key(out.read()) == key(want)
