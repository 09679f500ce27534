"""Connected components by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links -> (node, root), root being the smallest node of the
    component; nodes are the ends of links.

    Links point from the larger to the smaller end.  Every round hangs the larger
    neighbours of each node, then the smaller ones, on the smallest; after about log(n) rounds only stars are left.
    Minima are aggregated before they are shuffled and each round is written
    down, so neither a hot node nor a long lineage gathers in one place.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
        before = mark
        # large star: each node's larger neighbours go to its smallest one; the
        # minima are written down, so a node with very many neighbours is an ordinary
        # skewed key of the join, which is split at run time
        least = stored(edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")), "links")
        large = edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        # small star: the smaller neighbours of a node go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
