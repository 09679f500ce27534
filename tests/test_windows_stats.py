"""Sliding windows (G5, G6) and second-order statistics (G2)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from acctlens.config import AnalyzerConfig
from acctlens.operators.first_order import agg_lines, alive_counts, first_order
from acctlens.operators.second_order import second_order_stats, second_order_values, stats_from_values

CFG = AnalyzerConfig()  # 5 s / 30 s, sampleSize 12


def _records(spark, times, status="Alive", server="10.0.0.1"):
    rows = [(t, status, server, "c") for t in times]
    return spark.createDataFrame(rows, "date timestamp, acctStatusType string, nasIpAddress string, terminateCause string")


def test_g5_sliding_window(spark):
    out = alive_counts(_records(spark, [dt.datetime(2019, 12, 4, 0, 0, 7)]), CFG)
    assert sorted(r.timestamp for r in out.collect()) == [dt.datetime(2019, 12, 4, 0, 0, 10),
                                                          dt.datetime(2019, 12, 4, 0, 0, 15)]


def test_each_record_in_two_windows(spark):
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=3 * i) for i in range(50)]
    out = alive_counts(_records(spark, times), CFG)
    assert out.agg(F.sum("value")).first()[0] == 2 * len(times)


def _first(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp, aggField1 string, value long")


def _stats(spark, values, closed_form=True):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    rows = [(t0 + dt.timedelta(seconds=5 * (i % 6)), "k", v) for i, v in enumerate(values)]
    # all rows fall in the stage-2 window [00:00:30, 00:01:30)
    first = _first(spark, rows)
    df = (second_order_stats(first, CFG) if closed_form
          else stats_from_values(second_order_values(first, CFG)))
    return df.filter(F.col("timestamp") == dt.datetime(2024, 1, 1, 0, 1, 30)).first()


def test_g2_second_order(spark):
    cases = [([10] * 10, 10, 8.0, math.sqrt(14)), ([10] * 6 + [20] * 6, 12, 15.0, 5.0),
             ([1] * 13, 13, 1.0, 0.0), ([5], 1, 0.0, math.sqrt(2))]
    for values, n, mean, std in cases:
        for closed in (True, False):
            r = _stats(spark, values, closed)
            assert (r.samples, r.mean) == (n, mean)
            assert abs(r.stdDev - std) < 1e-12


def test_g2_exact(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    first = _first(spark, [(t0, "k", 10)] * 10)
    r = second_order_stats(first, CFG, exact=True).filter(F.col("timestamp") == dt.datetime(2024, 1, 1, 0, 1, 30)).first()
    assert abs(r.mean - 100 / 12) < 1e-12


def test_g6_stage_boundary(spark):
    first = _first(spark, [(dt.datetime(2024, 1, 1, 0, 1, 0), "k", 3)])
    ends = sorted(r.timestamp for r in second_order_stats(first, CFG).collect())
    assert ends == [dt.datetime(2024, 1, 1, 0, 1, 30), dt.datetime(2024, 1, 1, 0, 2, 0)]


def test_closed_form_equals_list_form_on_tables(spark):
    from tests.conftest import SF_MID
    from acctlens.plans.common import CFG as SCFG, records
    first = alive_counts(records(spark, SF_MID), SCFG)
    a = second_order_stats(first, SCFG)
    b = stats_from_values(second_order_values(first, SCFG))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_first_order_keys_and_lines(spark):
    recs = _records(spark, [dt.datetime(2024, 1, 1, 0, 0, 1)], status="Stop")
    four = first_order(recs, ["nasIpAddress", "terminateCause", "acctStatusType", "nasIpAddress"], 5, "x")
    assert four.columns == ["aggName", "timestamp", "value", "aggField1", "aggField2", "aggField3", "aggField4"]
    line = agg_lines(alive_counts(_records(spark, [dt.datetime(2024, 1, 1, 0, 0, 1)]), CFG)).orderBy("key").first()
    assert line.key == "2024-01-01 00:00:05.0-10.0.0.1"
    assert line.value == "agg1_cdr_alive_bras,2024-01-01 00:00:05.0,10.0.0.1,1"


def test_fill_silent_windows(spark):
    from acctlens.operators.first_order import fill_silent_windows
    t0 = dt.datetime(2024, 1, 1, 0, 0, 10)
    first = spark.createDataFrame([("n", t0, 4, "k"), ("n", t0 + dt.timedelta(seconds=15), 2, "k"),
                                   ("n", t0, 1, "z")],
                                  "aggName string, timestamp timestamp, value long, aggField1 string")
    got = sorted((r.aggField1, r.timestamp, r.value) for r in fill_silent_windows(first, 5).collect())
    assert got == [("k", t0, 4), ("k", t0 + dt.timedelta(seconds=5), 0), ("k", t0 + dt.timedelta(seconds=10), 0),
                   ("k", t0 + dt.timedelta(seconds=15), 2), ("z", t0, 1),
                   *[("z", t0 + dt.timedelta(seconds=x), 0) for x in (5, 10, 15)]]  # silent up to the end


def test_list_form_of_large_counts(spark):
    """Squares beyond 64 bits: the list form agrees with the closed form."""
    import datetime as dt

    big = [(dt.datetime(2024, 1, 1, 0, 0, 5 * i), "s", 4_000_000_000 + i * 10 ** 9) for i in range(10)]
    first = spark.createDataFrame(big, "timestamp timestamp, aggField1 string, value long")
    cfg = AnalyzerConfig()
    closed = second_order_stats(first, cfg)
    listed = stats_from_values(second_order_values(first, cfg))
    assert closed.count() == listed.count() > 0
    assert closed.exceptAll(listed.select(*closed.columns)).count() == 0
