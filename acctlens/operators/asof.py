"""Backward as-of join with a bounded lookback, as a bucketed equi-join.

For each left row: the right row with equal keys whose time lies in
``(left_time - lookback, left_time]`` and is the greatest such time.

Spark has no as-of join, and partitioning by the key alone would put every
row of a key (a hot server, or one with years of history) in one task.
Instead time is cut into buckets of ``bucket_seconds``; a right row is
copied into every bucket its lookback range reaches (``ceil(lookback /
bucket) + 1`` copies at most) and the join is an equi-join on ``(keys,
bucket)`` plus the exact range condition.  Groups are bounded by the bucket
width, whatever the key skew or history length.  The latest match is then
picked with ``max_by`` grouped by (keys, bucket, left row); that grouping
contains the join's hash partitioning, so no further shuffle is planned.
Left rows are partitioned that way first and equal ones counted, so duplicates
come out as often as they went in, again without a further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET, _TIMES = "_asof_bucket", "_asof_times"


def _floor_div(micros: Column, width_us: int) -> Column:
    return (micros - F.pmod(micros, F.lit(width_us))) / F.lit(width_us)


def time_bucket_of(time_col: Column, bucket_seconds: int) -> Column:
    width_us = int(bucket_seconds * 1_000_000)
    return _floor_div(F.unix_micros(time_col.cast("timestamp")), width_us).cast("bigint")


def asof_latest(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
                lookback_seconds: int, bucket_seconds: int | None = None, how: str = "inner",
                prefix: str = "") -> DataFrame:
    """Left columns + right non-key columns (renamed with ``prefix``).

    ``how='inner'`` keeps matched left rows only; ``'left'`` keeps all with
    nulls for no match.  Duplicate left rows stay duplicates."""
    bucket_seconds = bucket_seconds or lookback_seconds
    width_us = int(bucket_seconds * 1_000_000)
    look_us = int(lookback_seconds * 1_000_000)
    right_cols = [c for c in right.columns if c not in keys]
    renamed = {c: f"{prefix}{c}" for c in right_cols}
    r_time = renamed[right_time]
    for c in renamed.values():
        if c in left.columns:
            raise ValueError(f"column {c!r} exists on both sides; pass a prefix")

    r_us = F.unix_micros(F.col(right_time).cast("timestamp"))
    first_b = _floor_div(r_us, width_us).cast("bigint")
    last_b = _floor_div(r_us + F.lit(look_us - 1), width_us).cast("bigint")
    r = right.select(*[F.col(k) for k in keys], *[F.col(c).alias(renamed[c]) for c in right_cols],
                     F.explode(F.sequence(first_b, last_b)).alias(_BUCKET))
    lcols = left.columns
    l_df = (left.withColumn(_BUCKET, time_bucket_of(F.col(left_time), bucket_seconds))
            .repartition(*keys, _BUCKET).groupBy(*keys, _BUCKET, *[c for c in lcols if c not in keys])
            .agg(F.count(F.lit(1)).cast("int").alias(_TIMES)))

    lt = F.unix_micros(l_df[left_time].cast("timestamp"))
    rt = F.unix_micros(r[r_time].cast("timestamp"))
    cond = [l_df[k] == r[k] for k in keys] + [l_df[_BUCKET] == r[_BUCKET], rt <= lt, rt > lt - F.lit(look_us)]
    joined = l_df.join(r, cond, how).select(*[l_df[c] for c in lcols], l_df[_BUCKET], l_df[_TIMES],
                                            *[r[c] for c in renamed.values()])
    picked = F.max_by(F.struct(*[F.col(c) for c in renamed.values()]),
                      F.struct(F.col(r_time), *[F.col(c) for c in renamed.values() if c != r_time]))
    out = joined.groupBy(*keys, _BUCKET, *[c for c in lcols if c not in keys], _TIMES).agg(picked.alias("_m"))
    if how == "inner":
        out = out.filter(F.col("_m").isNotNull())
    out = out.withColumn(_TIMES, F.explode(F.sequence(F.lit(1), F.col(_TIMES))))
    return out.select(*lcols, *[F.col(f"_m.{c}").alias(c) for c in renamed.values()])
