"""Message-topic and table sinks (batch writes, micro-batch idempotent)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_topic(records: DataFrame, topic: str, bootstrap_servers: str, **options) -> None:
    """``key, value`` rows to a message topic (needs the Kafka connector)."""
    w = records.select(F.col("key").cast("string"), F.col("value").cast("string")).write.format("kafka") \
        .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def write_batch_table(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", by: tuple[str, ...] = ()) -> None:
    """Write one micro-batch as folder ``batch_id=n``, replacing what an
    earlier attempt of that batch left there, also when the batch is now empty: a
    retry gives the same table (idempotent, not transactional).  ``by`` are
    partition columns below the batch."""
    df.write.format(fmt).mode("overwrite").partitionBy(*by).save(f"{path}/batch_id={int(batch_id)}")


def head_sorted(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows in a fixed order (console displays)."""
    return df.orderBy(*order).limit(n) if order else df.orderBy(*df.columns).limit(n)


def read_batch_table(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """What :func:`write_batch_table` has written so far; an empty frame
    before the first batch.  Only "no such path" counts as that; every other error
    is raised."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        rows = spark.read.schema(schema).format(fmt).option("basePath", path).load(f"{path}/batch_id=*")
        return rows.select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
