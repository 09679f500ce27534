"""First-order aggregates: event counts per sliding event-time window and
1..4 key fields, in the ``(aggName, timestamp, value, aggField1..n)`` shape.

``timestamp`` is the window end.  Counting is a plain ``groupBy(window,
keys)``: Spark combines map-side (partial count per task) before the
shuffle, so a hot key costs one partial row per task, not a hot reducer.
Pass ``watermark_seconds`` on streaming input; the watermark is placed
*before* the status filter so every record advances event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlens.config import AnalyzerConfig
from acctlens.functions.scalars import java_timestamp_string

# fixed values: aggregate names
ALIVE_AGG_NAME = "agg1_cdr_alive_bras"
STOP_CAUSE_AGG_NAME = "agg1_cdr_stop_bras_termCause"
STATS_AGG_NAME = "agg2_cdr_alive_bras"


def sliding_window(time_col: str, slide_seconds: int) -> Column:
    """Window of ``2 * slide`` advancing by ``slide`` (epoch aligned)."""
    return F.window(time_col, f"{2 * slide_seconds} seconds", f"{slide_seconds} seconds")


def first_order(records: DataFrame, keys: list[str], slide_seconds: int, agg_name: str,
                time_col: str = "date", count_col: str | None = None,
                status: str | None = None, watermark_seconds: int | None = None,
                keep_window: bool = False) -> DataFrame:
    if not 1 <= len(keys) <= 4:
        raise ValueError("first-order aggregates have 1 to 4 key fields")
    df = records
    if watermark_seconds is not None:
        df = df.withWatermark(time_col, f"{watermark_seconds} seconds")
    if status is not None:
        df = df.filter(F.col("acctStatusType") == status)
    counter = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    key_cols = [F.col(k).alias(f"aggField{i}") for i, k in enumerate(keys, 1)]
    agg = df.groupBy(sliding_window(time_col, slide_seconds).alias("window"), *key_cols) \
        .agg(counter.alias("value"))
    return agg.select(F.lit(agg_name).alias("aggName"), F.col("window.end").alias("timestamp"),
                      "value", *[f"aggField{i}" for i in range(1, len(keys) + 1)],
                      *(["window"] if keep_window else []))


def alive_counts(records: DataFrame, cfg: AnalyzerConfig, streaming: bool = False,
                 keep_window: bool = False) -> DataFrame:
    """``Alive`` records per window and access server (NAS IP)."""
    return first_order(records, ["nasIpAddress"], cfg.bras_agg1_seconds, ALIVE_AGG_NAME,
                       count_col="nasIpAddress", status="Alive",
                       watermark_seconds=cfg.alive_watermark_seconds if streaming else None,
                       keep_window=keep_window)


def stop_cause_counts(records: DataFrame, cfg: AnalyzerConfig, streaming: bool = False) -> DataFrame:
    """``Stop`` records per window, access server and terminate cause."""
    return first_order(records, ["nasIpAddress", "terminateCause"], cfg.term_cause_agg1_seconds,
                       STOP_CAUSE_AGG_NAME, status="Stop",
                       watermark_seconds=cfg.stop_watermark_seconds if streaming else None)


def agg_lines(first: DataFrame) -> DataFrame:
    """First-order rows -> message ``key`` (``<ts>-<field1>``) and ``value``
    (``aggName,ts,field1..n,value``), timestamps rendered like
    ``java.sql.Timestamp.toString``."""
    fields = sorted([c for c in first.columns if c.startswith("aggField")])
    ts = java_timestamp_string(F.col("timestamp"))
    key = F.concat_ws("-", ts, F.col("aggField1"))
    value = F.concat_ws(",", F.col("aggName"), ts, *[F.col(c) for c in fields], F.col("value").cast("string"))
    return first.select(key.alias("key"), value.alias("value"))


def fill_silent_windows(first: DataFrame, slide_seconds: int) -> DataFrame:
    """Zero rows for windows without records, for every key over the whole
    range of windows in the input - before a key's first and after its last
    record as well, so a server that falls silent shows (the reference only
    ever sees dips).

    The range is one scalar; windows come from two sequences, days and then the
    windows of a day, so no row holds a key's whole history; an equi-join on
    (key, timestamp) puts the counts back."""
    keys = sorted(c for c in first.columns if c.startswith("aggField"))
    span = first.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    slide, day = int(slide_seconds), 86_400
    per_day = max(1, day // slide)
    lo, hi = F.unix_seconds(span.select("lo").scalar()), F.unix_seconds(span.select("hi").scalar())
    last = F.floor((F.col("_hi") - F.col("_lo")) / slide)
    days = (first.select("aggName", *keys).distinct().withColumn("_lo", lo).withColumn("_hi", hi)
            .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / per_day)))))
    grid = days.select("aggName", *keys, F.explode(F.transform(
        F.sequence(F.col("_block") * per_day, F.least(last, (F.col("_block") + 1) * per_day - 1)),
        lambda i: F.timestamp_seconds(F.col("_lo") + i * slide))).alias("timestamp"))
    on = (F.col("g.timestamp") == F.col("c.timestamp")) & (F.col("g.aggName") == F.col("c.aggName"))
    for k in keys:
        on = on & F.col(f"g.{k}").eqNullSafe(F.col(f"c.{k}"))
    counted = first.select("aggName", "timestamp", *keys, "value")
    return grid.alias("g").join(counted.alias("c"), on, "left").select(
        "g.aggName", "g.timestamp", F.coalesce("c.value", F.lit(0).cast("bigint")).alias("value"), *[f"g.{k}" for k in keys])
