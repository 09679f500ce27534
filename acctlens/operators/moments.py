"""Moments of a column in a form that merges: count, mean, sum of squared
deviations, least and greatest value of each batch.

Deviations are taken from the batch's own mean and merged by the distance of the
means, so a large common offset costs no digits, and neither the order nor the size
of batches matters.  A batch is one small row, kept as a table; the sigma rule then
spans all batches so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOMENTS = "count long, mean double, deviation double, min double, max double"


def batch_moments(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """``by, count, mean, deviation, min, max``; nulls are left out, and without any
    value the count is 0 and the rest null."""
    c = F.col(col).cast("double")
    return df.groupBy(*(by or [])).agg(F.count(c).alias("count"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("deviation"),
                                       F.min(c).alias("min"), F.max(c).alias("max"))


def merged_moments(moments: DataFrame) -> DataFrame:
    """One MOMENTS row for rows of :func:`batch_moments`."""
    some = moments.filter("count > 0")
    # means are weighed by their distance from one of them, not by their size
    origin = some.agg(F.min("mean").alias("m")).select("m").scalar()
    around = some.withColumn("_origin", origin)
    total = around.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.first("_origin").alias("_origin"),
                       (F.sum(F.col("count") * (F.col("mean") - F.col("_origin"))) / F.sum("count")).alias("_shift"),
                       F.sum("deviation").alias("_within"), F.sum(F.col("count") * (F.col("mean") - F.col("_origin")) ** 2).alias("_between"),
                       F.min("min").alias("min"), F.max("max").alias("max"))
    between = F.col("_between") - F.col("count") * F.col("_shift") ** 2
    return total.select(F.col("count").cast("long").alias("count"), (F.col("_origin") + F.col("_shift")).alias("mean"),
                        (F.col("_within") + F.greatest(between, F.lit(0.0))).alias("deviation"), "min", "max")


def sample_stddev(moments: DataFrame) -> DataFrame:
    """Adds ``stddev`` (sample; null under two values)."""
    return moments.withColumn("stddev", F.when(F.col("count") > 1, F.sqrt(F.col("deviation") / (F.col("count") - 1))))


def beyond_sigmas(df: DataFrame, moments: DataFrame, sigmas: float = 2.0, col: str = "distanceFromCenter") -> DataFrame:
    """Rows strictly above mean + sigmas * stddev of merged moments."""
    limit = sample_stddev(moments).select(F.col("mean") + F.lit(float(sigmas)) * F.col("stddev")).scalar()
    return df.filter(F.col(col) > limit)
