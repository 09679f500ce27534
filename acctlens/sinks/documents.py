"""Search-index documents as table rows (epoch-millisecond timestamps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.functions.scalars import epoch_millis
from acctlens.schema import INDEX_DOC_1_SCHEMA, INDEX_DOC_2_SCHEMA, conform


def index_documents_1(first: DataFrame) -> DataFrame:
    """First-order rows -> ``value, timestamp, aggName, aggField1, nasIpAddress``."""
    docs = first.select("value", epoch_millis("timestamp").alias("timestamp"), "aggName", "aggField1",
                        F.col("aggField1").alias("nasIpAddress"))
    return conform(docs, INDEX_DOC_1_SCHEMA)


def index_documents_2(stats: DataFrame) -> DataFrame:
    """Stats rows -> ``mean, stdDev, timestamp, aggName, aggField1,
    nasIpAddress`` (``samples`` is not indexed)."""
    docs = stats.select("mean", "stdDev", epoch_millis("timestamp").alias("timestamp"), "aggName", "aggField1",
                        F.col("aggField1").alias("nasIpAddress"))
    return conform(docs, INDEX_DOC_2_SCHEMA)
