"""As-of lookup and the lower-side anomaly rule (G3)."""

import datetime as dt

from acctlens.config import AnalyzerConfig
from acctlens.operators.anomaly import alive_anomalies, latest_stats
from acctlens.operators.asof import asof_latest

CFG = AnalyzerConfig()  # n = 4, lookback 150 s
T = dt.datetime(2024, 1, 1, 1, 0, 0)


def _counts(spark, rows):
    return spark.createDataFrame([("a1", t, k, v) for t, k, v in rows],
                                 "aggName string, timestamp timestamp, aggField1 string, value long")


def _stats(spark, rows):
    return spark.createDataFrame([("a2", t, k, m, s, 12) for t, k, m, s in rows],
                                 "aggName string, timestamp timestamp, aggField1 string, mean double, stdDev double, samples int")


def test_g3(spark):
    stats = _stats(spark, [(T - dt.timedelta(seconds=30), "k", 100.0, 5.0),
                           (T - dt.timedelta(seconds=30), "z", 100.0, 0.0)])
    counts = _counts(spark, [(T, "k", 80), (T + dt.timedelta(seconds=1), "k", 79),
                             (T + dt.timedelta(seconds=2), "k", 200), (T, "z", 99),
                             (T + dt.timedelta(seconds=200), "k", 1)])
    got = sorted((r.aggField1, r.value) for r in alive_anomalies(counts, stats, CFG).collect())
    assert got == [("k", 79), ("z", 99)]


def test_latest_wins_and_lookback(spark):
    stats = _stats(spark, [(T - dt.timedelta(seconds=120), "k", 1.0, 0.0), (T - dt.timedelta(seconds=60), "k", 2.0, 0.0),
                           (T, "k", 3.0, 0.0), (T + dt.timedelta(seconds=30), "k", 4.0, 0.0)])
    counts = _counts(spark, [(T, "k", 0), (T - dt.timedelta(seconds=61), "k", 0), (T - dt.timedelta(seconds=300), "k", 0)])
    got = {r.timestamp: r.mean for r in latest_stats(counts, stats, CFG).collect()}
    assert got[T] == 3.0                                   # stamp equal to the count wins (inclusive)
    assert got[T - dt.timedelta(seconds=61)] == 1.0        # newer ones are in the future
    assert got[T - dt.timedelta(seconds=300)] is None      # nothing within the lookback


def test_asof_bucket_width_does_not_change_result(spark):
    import random
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(f"k{rnd.randint(0, 3)}", base + dt.timedelta(seconds=rnd.randint(0, 5000)), i)
                                  for i in range(300)], "k string, t timestamp, id long")
    right = spark.createDataFrame([(f"k{rnd.randint(0, 3)}", base + dt.timedelta(seconds=rnd.randint(0, 5000)), float(i))
                                   for i in range(200)], "k string, rt timestamp, x double").dropDuplicates(["k", "rt"])
    results = []
    for bucket in (7, 60, 400, 1000):
        df = asof_latest(left, right, ["k"], "t", "rt", 400, bucket_seconds=bucket, how="left")
        results.append(sorted((r.id, r.x) for r in df.collect()))
    # brute force
    lrows, rrows = left.collect(), right.collect()
    brute = []
    for lr in lrows:
        cands = [r for r in rrows if r.k == lr.k and lr.t - dt.timedelta(seconds=400) < r.rt <= lr.t]
        brute.append((lr.id, max(cands, key=lambda r: r.rt).x if cands else None))
    for res in results:
        assert res == sorted(brute, key=lambda p: p[0])
