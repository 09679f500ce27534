"""Second-order statistics of first-order counts over longer windows.

For each stage-2 window and key there should be ``N = sampleSize`` counts;
missing ones are zeros.  The reference collects the list, pads it and uses
truncating long arithmetic:

    mean   = sum(v) div N
    stdDev = sqrt( sum((v - mean)^2 over the padded list) div N )

The list is not needed: with n = count, s = sum, q = sum(v*v),
``sum((v-m)^2) = q - 2*m*s + m*m*max(n, N)`` exactly (an oversized list is
not padded, hence ``max``).  Three sums combine map-side, so the
shuffle carries one partial row per task and key instead of every value.  Squares
are summed as decimals: they neither overflow nor lose digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.config import AnalyzerConfig
from acctlens.operators.first_order import STATS_AGG_NAME, sliding_window


_WIDE = "decimal(38,0)"


def chained_window(cfg: AnalyzerConfig):
    """Stage-2 window over a *streaming* stage-1 result that still carries
    its ``window`` struct.  A plain copy of ``window.end`` has no event-time
    watermark, so the stage-2 window is placed on ``window_time(window)`` =
    end - 1 us, with windows shifted by -1 us (start offset slide - 1 us):
    a count stamped T then lands in exactly the windows ``[kS, kS + 2S)``
    holding T, and the reported end gets the microsecond back."""
    s = cfg.bras_agg2_seconds
    return F.window(F.window_time("window"), f"{2 * s} seconds", f"{s} seconds",
                    f"{s * 1_000_000 - 1} microseconds")


def _windowed(first: DataFrame, cfg: AnalyzerConfig, key: str, watermark_seconds: int | None,
              chained: bool = False):
    df = first
    if watermark_seconds is not None:
        df = df.withWatermark("timestamp", f"{watermark_seconds} seconds")
    w = chained_window(cfg) if chained else sliding_window("timestamp", cfg.bras_agg2_seconds)
    return df.groupBy(w.alias("window"), key)


def _window_end(chained: bool):
    end = F.col("window.end")
    return end + F.expr("INTERVAL 1 MICROSECOND") if chained else end


def second_order_stats(first: DataFrame, cfg: AnalyzerConfig, exact: bool = False, key: str = "aggField1",
                       agg_name: str = STATS_AGG_NAME, watermark_seconds: int | None = None,
                       chained: bool = False, keep_event_time: bool = False) -> DataFrame:
    """``aggName, timestamp, aggField1, mean, stdDev, samples``.
    ``exact=True`` gives real-valued mean and standard deviation;
    ``chained=True`` reads a streaming stage-1 result with its ``window``;
    ``keep_event_time`` adds ``eventTime``, which carries the watermark on."""
    n_s = cfg.sample_size
    g = _windowed(first, cfg, key, watermark_seconds, chained).agg(
        F.count("value").alias("_n"), F.sum("value").alias("_s"),
        F.sum((F.col("value").cast("decimal(19,0)") * F.col("value").cast("decimal(19,0)")).cast(_WIDE)).alias("_q"))
    if exact:
        # N^3 var = N^2 q - 2 N s^2 + max(n, N) s^2, in whole numbers
        mean = F.col("_s") / F.lit(float(n_s))
        s2 = f"CAST(CAST(_s AS DECIMAL(19,0)) * CAST(_s AS DECIMAL(19,0)) AS {_WIDE})"
        scaled = F.expr(f"CAST({n_s * n_s} * _q AS {_WIDE}) + CAST((greatest(_n, {n_s}) - {2 * n_s}) * {s2} AS {_WIDE})")
        std = F.sqrt(scaled.cast("double") / F.lit(float(n_s) ** 3))
    else:
        mean = F.expr(f"_s div {n_s}")
        m = f"CAST(_s div {n_s} AS DECIMAL(19,0))"
        var = F.expr(f"(_q - CAST(2 * {m} * CAST(_s AS DECIMAL(19,0)) AS {_WIDE}) "
                     f"+ CAST(CAST({m} * {m} AS {_WIDE}) * greatest(_n, {n_s}) AS {_WIDE})) div {n_s}")
        std = F.sqrt(var.cast("double"))
    return g.select(F.lit(agg_name).alias("aggName"), _window_end(chained).alias("timestamp"),
                    F.col(key).alias("aggField1"), mean.cast("double").alias("mean"),
                    std.alias("stdDev"), F.col("_n").cast("int").alias("samples"),
                    *([F.window_time("window").alias("eventTime")] if keep_event_time else []))


def second_order_values(first: DataFrame, cfg: AnalyzerConfig, key: str = "aggField1",
                        watermark_seconds: int | None = None) -> DataFrame:
    """List form: ``window, aggField1, values, sampleSize`` (values sorted;
    at most one per stage-1 window, so a list holds about ``sampleSize``)."""
    g = _windowed(first, cfg, key, watermark_seconds).agg(F.sort_array(F.collect_list("value")).alias("values"))
    return g.select("window", F.col(key).alias("aggField1"), "values",
                    F.lit(cfg.sample_size).alias("sampleSize"))


def zero_filled(values: str = "values", size: str = "sampleSize"):
    """Pad with zeros up to ``sampleSize``; longer lists are kept whole."""
    pad = F.greatest(F.col(size) - F.size(values), F.lit(0))
    return F.concat(F.col(values), F.array_repeat(F.lit(0).cast("bigint"), pad))


def stats_from_values(raw: DataFrame, agg_name: str = STATS_AGG_NAME) -> DataFrame:
    """Reference list arithmetic on ``second_order_values`` output (cross-check
    of the closed form)."""
    df = raw.select("window", "aggField1", "values", "sampleSize",
                    F.expr("aggregate(values, 0L, (a, v) -> a + v) div sampleSize").alias("_m"),
                    zero_filled().alias("_filled"))
    away = "CAST(v - _m AS DECIMAL(19,0))"  # squares as decimals: they don't overflow
    var = F.expr(f"aggregate(_filled, CAST(0 AS {_WIDE}), (a, v) -> CAST(a + {away} * {away} AS {_WIDE})) div sampleSize")
    return df.select(F.lit(agg_name).alias("aggName"), F.col("window.end").alias("timestamp"), "aggField1",
                     F.col("_m").cast("double").alias("mean"), F.sqrt(var.cast("double")).alias("stdDev"),
                     F.size("values").alias("samples"))
