"""Sum of array vectors per key, place by place.

Vectors may differ in length: the sum is as long as the shortest vector that is
not empty, an empty vector counts as zeros, null vectors and null entries add
nothing.  A key without any entry has the empty sum.

Entries are summed as rows of (key, place), which combine map-side, and the
shortest length is found along the way: every vector that isn't empty has a place 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_sum(df: DataFrame, keys: list[str], vector: str, out: str = "sum") -> DataFrame:
    """``keys, <out> array<double>``; keys may be null."""
    v = F.col(vector).cast("array<double>")
    places = df.select(*keys, F.size(v).alias("_size"), F.posexplode_outer(v).alias("_place", "_x"))
    sums = places.groupBy(*keys, "_place").agg(F.coalesce(F.sum("_x"), F.lit(0.0)).alias("_x"), F.min("_size").alias("_size"))
    whole = sums.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("_place").isNotNull(), F.struct("_place", "_x")))).alias("_sums"),
        F.min(F.when(F.col("_place") == 0, F.col("_size"))).alias("_width"))
    return whole.select(*keys, F.transform(F.slice("_sums", F.lit(1), F.coalesce("_width", F.lit(0))), lambda s: s["_x"]).alias(out))
