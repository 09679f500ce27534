"""Generic sources of accounting lines.

Every source yields a ``value string`` column (plus optional ``key``), the
shape of a message-topic record after decoding, so parsing is identical for
topics, text folders and tables.  All functions accept batch or streaming
readers (``spark.read`` / ``spark.readStream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def value_strings(envelope: DataFrame) -> DataFrame:
    """Decode a topic envelope (key, value, topic, partition, offset,
    timestamp, timestampType) to the string ``value`` the parsers read."""
    return envelope.select(F.col("value").cast("string").alias("value"))


def read_topic(spark: SparkSession, topic: str, bootstrap_servers: str, streaming: bool = True,
               starting_offsets: str | None = None, **options) -> DataFrame:
    """Subscribe to a message topic (needs the Kafka connector on the
    classpath).  Like the reference, the default start is the latest offset."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers) \
        .option("subscribe", topic)
    if starting_offsets:
        reader = reader.option("startingOffsets", starting_offsets)
    for k, v in options.items():
        reader = reader.option(k, v)
    return value_strings(reader.load())


def read_lines(spark: SparkSession, path: str, fmt: str = "text", streaming: bool = False,
               column: str = "value", **options) -> DataFrame:
    """Lines from a text folder (``fmt='text'``) or a string column of a
    table (``parquet``/``orc``/...).  Streaming readers take e.g.
    ``maxFilesPerTrigger`` through ``options``."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.select(F.col(column).cast("string").alias("value"))
