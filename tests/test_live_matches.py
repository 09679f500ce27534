"""The live check's join: all pairs within the lookback, each once, found by bucket of time."""

import datetime as dt
import random

from acctlens.config import AnalyzerConfig
from acctlens.streaming.live import live_matches

CFG = AnalyzerConfig()
START = dt.datetime(2024, 1, 1)
US = dt.timedelta(microseconds=1)


def test_matches_equal_all_pairs_within_the_lookback(spark):
    pick, at = random.Random(5), lambda s: START + dt.timedelta(seconds=s)
    counts = [(f"n{k}", at(5 * pick.randrange(-200, 400)), pick.randrange(9)) for k in (1, 2) for _ in range(120)]
    counts += counts[:3] + [("n1", at(CFG.lookback_seconds * 3), 1), ("n3", at(0), 1), (None, at(0), 1)]
    stats = [(f"n{k}", at(30 * pick.randrange(-40, 70)), float(i)) for k in (1, 2) for i in range(60)]
    stats += stats[:2] + [("n1", at(0), 0.5), ("n1", at(CFG.lookback_seconds * 2), 1.5), (None, at(0), 1.0)]
    c = spark.createDataFrame([("a", t, k, v, t - US) for k, t, v in counts], "aggName string, timestamp timestamp, aggField1 string, value long, eventTime timestamp")
    s = spark.createDataFrame([("b", t, k, m, 1.0, 1, t - 2 * US) for k, t, m in stats],
                              "aggName string, timestamp timestamp, aggField1 string, mean double, stdDev double, samples int, eventTime timestamp")
    found = live_matches(c, s, CFG)
    far = dt.timedelta(seconds=CFG.lookback_seconds)
    want = sorted((k, t, v, u, m) for k, t, v in counts for j, u, m in stats if k is not None and k == j and t - far < u <= t)
    assert sorted((r.aggField1, r.timestamp, r.value, r.statsTimestamp, r.mean) for r in found.collect()) == want and want
    assert found.columns == ["aggName", "timestamp", "aggField1", "value", "statsTimestamp", "mean", "stdDev"]


def test_a_long_batch_does_not_pair_all_counts_with_all_statistics(spark):
    """One server, years in one batch: the bucket is a key of the join, beside the server."""
    t = "timestamp_seconds(id * 5) - INTERVAL 1 MICROSECOND"
    c = spark.range(1000).selectExpr("'a' aggName", "timestamp_seconds(id * 5) timestamp", "'n' aggField1", "id value", f"{t} eventTime")
    s = spark.range(1000).selectExpr("timestamp_seconds(id * 30) timestamp", "'n' aggField1", "1D mean", "1D stdDev",
                                     "timestamp_seconds(id * 30) - INTERVAL 2 MICROSECOND eventTime")
    plan = live_matches(c, s, CFG)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan and "_reached" in plan
