"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from acctlens.session import scratch_path

#: ASCII white space only: the words of every contract are runs of other characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: later passes start from files every executor can reach, so
    a lost executor never replays what came before."""
    path = scratch_path(df.sparkSession, f"llm/{name}", unique=True)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def utf8_rows(rb: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    col = rb.column(rb.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    for x in col.cast(kind):
        yield x.as_py() or b""
