"""Shared building blocks of the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctlens.config import SCALED_CONFIG
from acctlens.operators.ingest import parse_cdr
from acctlens.sources.events import read_event_lines

CFG = SCALED_CONFIG


def to_output(df: DataFrame) -> DataFrame:
    """Session-zone timestamps -> ``timestamp_ntz`` (wall-clock UTC), the
    type plain SQL engines give back for these columns."""
    cols = [F.col(f.name).cast(T.TimestampNTZType()).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_event_lines(spark, sf_dir)


def records(spark: SparkSession, sf_dir: str, layout: str = "cdr24") -> DataFrame:
    return parse_cdr(lines(spark, sf_dir), layout)
