"""Cases that used to lose rows or change answers silently."""

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from acctlens.config import AnalyzerConfig
from acctlens.operators import cause_mix as cm
from acctlens.operators.asof import asof_latest
from acctlens.operators.first_order import ALIVE_AGG_NAME, agg_lines, alive_counts, fill_silent_windows, first_order
from acctlens.operators.ingest import parse_agg_line, parse_cdr
from acctlens.operators.replay import rebase_lines, replay_quarantine
from acctlens.operators.second_order import second_order_stats
from acctlens.schema import INDEX_DOC_1_SCHEMA, INDEX_DOC_2_SCHEMA, INDEX_TEMPLATE_SCHEMA
from acctlens.sinks.documents import index_documents_1, index_documents_2
from acctlens.sinks.topics import head_sorted, read_batch_table, write_batch_table
from acctlens.sources.events import event_lines_path
from acctlens.sources.lines import value_strings
from acctlens.sources.minute_files import minute_file_lines, write_minute_files
from tests.conftest import SF_SMALL, lines_df

DAY = dt.datetime(2019, 12, 4)
REAL = dt.datetime(2026, 1, 1)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="acctlens-edges-")


def line(time, status="Alive", session="S", leaf="bras01", server="10.0.0.1", cause=""):
    f = [time, "1", status, session, "1", "1", "0", "2", "0", "1", "2", leaf, server, "7", "C", "1", "u", "n", "", "r", "i", "c",
         cause, "0", "0", "0", "", "m"]
    return ",".join(f)


def test_records_before_the_replay_start_are_due_at_once(spark):
    got = rebase_lines(lines_df(spark, [line("2019/12/03 23:59:59"), line("2019/12/04 00:00:10")]), DAY, REAL, factor=10).collect()
    assert [(r.releaseTime, r.value[:19]) for r in got] == [(REAL, "2026/01/01 00:00:00"),
                                                            (REAL + dt.timedelta(seconds=1), "2026/01/01 00:00:01")]


def test_replay_quarantine(spark):
    bad = ["2019/12/04 00:00:09,1,Alive,S5", line("2019-12-04"), line("nonsense")]
    rows = lines_df(spark, [*bad, line("2019/12/04 00:00:10")])
    assert [(r.value, r.reason) for r in replay_quarantine(rows).collect()] == list(zip(bad, ["too_few_fields", "bad_date", "bad_date"]))
    assert rebase_lines(rows, DAY, REAL).count() == 1


def test_empty_minute_files_are_present(spark, folder):
    os.makedirs(f"{folder}/007")
    for m in (0, 1, 15, 30):
        with open(f"{folder}/007/cdr.2019-12-04T00-{m:02d}.txt", "w") as f:
            f.write("" if m == 15 else line(f"2019/12/04 00:{m:02d}:05") + "\n")
    got = minute_file_lines(spark, folder, "2019-12-04T00-00", layout="reference").collect()
    assert sorted((r.leaf, r.minute.minute) for r in got) == [("007", 0), ("007", 1), ("007", 30)]


def test_written_minute_files(spark, folder):
    rows = [line(f"2019/12/04 00:{m:02d}:05", leaf=leaf) for leaf in ("007", "012") for m in (0, 1, 30)] + [line("no date")]
    present = spark.createDataFrame([("007", DAY + dt.timedelta(minutes=15))], "leaf string, minute timestamp")
    assert write_minute_files(lines_df(spark, rows), folder, present=present) == 1
    got = minute_file_lines(spark, folder, "2019-12-04T00-00").collect()
    assert sorted((r.leaf, r.minute.minute) for r in got) == [("007", 0), ("007", 1), ("007", 30), ("012", 0), ("012", 1)]


@pytest.mark.parametrize("layout", ["partitioned", "reference"])
def test_minute_lines_are_read_once_and_not_shuffled(spark, folder, layout):
    if layout == "partitioned":
        write_minute_files(lines_df(spark, [line(f"2019/12/04 00:{m}:05") for m in ("00", "50")]), folder)
    else:
        os.makedirs(f"{folder}/a")
        for m in ("00", "50"):
            with open(f"{folder}/a/cdr.2019-12-04T00-{m}.txt", "w") as f:
                f.write(line(f"2019/12/04 00:{m}:05") + "\n")
    df = minute_file_lines(spark, folder, "2019-12-04T00-00", layout=layout)
    assert [r.minute.minute for r in df.collect()] == [0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert plan.count("FileScan text") == 1 and "BroadcastHashJoin" in plan
    assert not re.search(r"(?<!Broadcast)Exchange ", plan), plan


def counts(spark, rows):
    return spark.createDataFrame([("a", DAY + dt.timedelta(seconds=5 * t), v, k) for k, t, v in rows],
                                 "aggName string, timestamp timestamp, value long, aggField1 string")


def test_silent_servers_are_filled_to_the_whole_range(spark):
    got = fill_silent_windows(counts(spark, [("live", i, 1) for i in range(40_000, 40_020)] + [("dead", 40_005, 3), (None, 40_001, 2)]), 5)
    rows = {(r.aggField1, r.timestamp): r.value for r in got.collect()}
    assert len(rows) == 3 * 20
    assert [rows["dead", DAY + dt.timedelta(seconds=5 * (40_000 + i))] for i in range(20)] == [0] * 5 + [3] + [0] * 14
    assert sum(v for (k, _), v in rows.items() if k is None) == 2


def test_silent_windows_over_several_days(spark):
    got = fill_silent_windows(counts(spark, [("a", 0, 1), ("b", 40_000, 1)]), 5)
    assert got.count() == got.distinct().count() == 2 * 40_001


def test_duplicate_left_rows_stay(spark):
    left = spark.createDataFrame([("k", DAY, 1)] * 3 + [("x", DAY, 1)] * 2, "k string, t timestamp, v long")
    right = spark.createDataFrame([("k", DAY, 2.0), ("k", DAY, 2.0)], "k string, rt timestamp, x double")
    assert asof_latest(left, right, ["k"], "t", "rt", 60).count() == 3
    assert asof_latest(left, right, ["k"], "t", "rt", 60, how="left").count() == 5


def test_a_retried_batch_replaces_what_it_left(spark, folder):
    for ids in (range(5), range(0)):
        write_batch_table(spark.createDataFrame([(i,) for i in ids], "v long"), f"{folder}/t", 3)
    write_batch_table(spark.createDataFrame([(9,)], "v long"), f"{folder}/t", 4)
    assert [r.v for r in read_batch_table(spark, f"{folder}/t", "v long").collect()] == [9]


def test_only_a_missing_table_reads_as_empty(spark, folder):
    assert read_batch_table(spark, f"{folder}/none", "v long").count() == 0
    os.makedirs(f"{folder}/t/batch_id=1")
    with open(f"{folder}/t/batch_id=1/part-0.parquet", "w") as f:
        f.write("not a parquet file")
    with pytest.raises(Exception, match="parquet"):
        read_batch_table(spark, f"{folder}/t", "v long").collect()


def test_line_cache_follows_a_rewritten_directory_table(spark, folder):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for n in (100, 40):
        events.limit(n).write.mode("overwrite").parquet(f"{folder}/events.parquet")
        assert spark.read.text(event_lines_path(spark, folder)).count() == n


def test_line_files_follow_each_other_in_time(spark):
    rows = spark.read.text(event_lines_path(spark, SF_SMALL)).select(F.col("_metadata.file_path").alias("f"), F.substring("value", 1, 10).alias("d"),
                                                                     F.col("_metadata.file_modification_time").alias("m"))
    spans = rows.groupBy("f", "m").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).orderBy("m").collect()
    assert len(spans) >= 5
    assert all(a.hi <= b.lo and a.f < b.f for a, b in zip(spans, spans[1:]))


def test_unknown_causes_share_a_bucket(spark):
    rows = spark.createDataFrame([("s", DAY, "U", 3), ("s", DAY, "new", 1), ("s", DAY, "odd", 1)],
                                 "aggField1 string, timestamp timestamp, aggField2 string, value long")
    ratios = cm.cause_ratio(rows, "batch")
    model = cm.fit_features(ratios, ["U", "L"])
    got = cm.features_long(cm.cause_features(ratios, model, "batch"), cm.model_labels(model), "batch").collect()
    assert {r.cause: r.ratioSum for r in got} == {"U": 0.6, "L": 0.0, cm.UNKNOWN_CAUSE: 0.4}


def test_exact_statistics_of_large_counts(spark):
    cfg = AnalyzerConfig()
    big = counts(spark, [("a", i, 300_000_000 + 2 * (i % 2)) for i in range(12)])
    full = second_order_stats(big, cfg, exact=True).filter("samples = 12").collect()
    assert full and all(r.stdDev == 1.0 and r.mean == 300_000_001.0 for r in full)
    huge = counts(spark, [("a", i, 4_000_000_000) for i in range(12)])
    for exact in (True, False):
        assert all(r.stdDev == 0.0 for r in second_order_stats(huge, cfg, exact=exact).filter("samples = 12").collect())
    many = counts(spark, [("a", 1, 1)] * 13)  # more values than the sample holds
    r = second_order_stats(many, cfg, exact=True).first()
    assert r.samples == 13 and r.mean == pytest.approx(13 / 12) and r.stdDev == pytest.approx((13 * (1 - 13 / 12) ** 2 / 12) ** 0.5)


def test_late_rows_are_dropped_after_their_window_closed(spark, folder):
    at = lambda s: (DAY + dt.timedelta(seconds=s)).strftime("%Y/%m/%d %H:%M:%S")
    files = [[0, 1, 2], [20, 21], [40], [60, 3, 22], [80], [100, 41]]  # 3, 22 and 41 are late; only 22 still counts
    os.makedirs(f"{folder}/in")
    for i, seconds in enumerate(files):
        with open(f"{folder}/in/{i}.txt", "w") as f:
            f.write("".join(line(at(s)) + "\n" for s in seconds))
        os.utime(f"{folder}/in/{i}.txt", (1_700_000_000 + i,) * 2)
    stream = parse_cdr(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{folder}/in"))
    q = (alive_counts(stream, AnalyzerConfig(), streaming=True).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start(f"{folder}/out"))
    q.awaitTermination()
    progress = q.recentProgress
    assert sum(p["numInputRows"] > 0 for p in progress) == len(files)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    got = {(r.timestamp - DAY).seconds: r.value for r in spark.read.parquet(f"{folder}/out").collect()}
    # a batch closes windows up to the newest time of the batches before, less 3 s, and
    # drops rows of windows that an earlier batch has closed; each row is in two windows
    late, newest, closing, closed, want = 0, None, None, None, {}
    for seconds in files:
        closed, closing = closing, None if newest is None else newest - 3
        for s in seconds:
            for end in (s // 5 * 5 + 5, s // 5 * 5 + 10):
                if closed is not None and end <= closed:
                    late += 1
                else:
                    want[end] = want.get(end, 0) + 1
        newest = max([newest or 0, *seconds])
    closed = newest - 3
    assert dropped == late == 4
    assert got == {e: n for e, n in want.items() if e <= closed}


def test_envelopes_heads_and_aggregate_lines(spark):
    env = spark.createDataFrame([(bytearray(b"k"), bytearray("a,é".encode()), "cdr", 0, 1)], "key binary, value binary, topic string, partition int, offset long")
    assert [r.value for r in value_strings(env).collect()] == ["a,é"]
    rows = spark.createDataFrame([(3,), (1,), (2,)], "v long")
    assert [r.v for r in head_sorted(rows, 2, "v").collect()] == [1, 2]
    for n in (3, 4):
        keys = ",".join(f"k{i}" for i in range(n))
        r = parse_agg_line(lines_df(spark, [f"agg,2019-12-04 00:00:05.0,{keys},7"]), n).first()
        assert r.value == 7 and [r[f"aggField{i}"] for i in range(1, n + 1)] == [f"k{i}" for i in range(n)]
    records = spark.createDataFrame([(DAY, "Alive", "s")], "date timestamp, acctStatusType string, nasIpAddress string")
    other = first_order(records, ["nasIpAddress"], 5, "another_name")
    alive = alive_counts(records, AnalyzerConfig())
    parsed = parse_agg_line(agg_lines(alive.unionByName(other)), 1)
    assert parsed.count() == 4 and parsed.filter(F.col("aggName") == ALIVE_AGG_NAME).count() == 2


def test_guards_and_document_schemas(spark):
    with pytest.raises(ValueError):
        AnalyzerConfig(bras_agg1_seconds=7)
    first = counts(spark, [("a", 1, 1)])
    assert index_documents_1(first).schema == INDEX_DOC_1_SCHEMA or index_documents_1(first).schema.names == INDEX_DOC_1_SCHEMA.names
    assert [f.dataType for f in index_documents_2(second_order_stats(first, AnalyzerConfig())).schema] == [f.dataType for f in INDEX_DOC_2_SCHEMA]
    known = {f.name: f.dataType for f in INDEX_TEMPLATE_SCHEMA}  # a date field takes epoch milliseconds, mean is the template's avg
    for schema in (INDEX_DOC_1_SCHEMA, INDEX_DOC_2_SCHEMA):
        assert all(known[f.name] == f.dataType for f in schema if f.name not in ("timestamp", "mean", "aggName"))
