"""Liveness anomaly: a fresh count far *below* the latest statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.config import AnalyzerConfig
from acctlens.operators.asof import asof_latest


def latest_stats(counts: DataFrame, stats: DataFrame, cfg: AnalyzerConfig, how: str = "left") -> DataFrame:
    """Each first-order count with the newest stats row of the same key
    stamped in ``(timestamp - lookback, timestamp]`` (null when none).

    Buckets are one stage-2 slide wide: stats are stamped on that grid, so
    each stats row is copied ``lookback / slide`` times and every bucket
    holds at most ``slide / stage-1 slide`` counts per key."""
    s = stats.select("aggField1", F.col("timestamp").alias("statsTimestamp"), "mean", "stdDev")
    c = counts.select("aggName", "timestamp", "aggField1", "value")
    return asof_latest(c, s, ["aggField1"], "timestamp", "statsTimestamp", cfg.lookback_seconds,
                       bucket_seconds=cfg.bras_agg2_seconds, how=how)


def lower_side_anomalies(matched: DataFrame, n_std_dev: float) -> DataFrame:
    """Strictly more than ``n`` standard deviations below the mean; rows
    without statistics give no verdict."""
    return matched.filter((F.col("mean") - F.col("value")) > F.lit(float(n_std_dev)) * F.col("stdDev"))


def alive_anomalies(counts: DataFrame, stats: DataFrame, cfg: AnalyzerConfig,
                    n_std_dev: float | None = None) -> DataFrame:
    n = cfg.bras_std_dev_anomaly if n_std_dev is None else n_std_dev
    return lower_side_anomalies(latest_stats(counts, stats, cfg, how="inner"), n)
