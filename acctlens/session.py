"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder every job writes intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "acctlens") -> SparkSession:
    """Master and partition count are set only if given (tests, bench); a
    submitted job keeps those of its cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ACCTLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every query relies on.  Event times are interpreted in UTC so
    that ``timestamp_ntz`` inputs and ``timestamp`` (needed by watermarks)
    convert one-to-one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/S3/...); a machine-local fallback is
    only created for local-mode sessions such as tests.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running acctlens jobs")
    root = tempfile.mkdtemp(prefix="acctlens-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str, unique: bool = False) -> str:
    """A folder under the shared checkpoint root for written intermediate
    tables and streaming checkpoints."""
    base = f"{checkpoint_root(spark)}/acctlens/{name}"
    return f"{base}/{uuid.uuid4().hex}" if unique else base


def materialize(df):
    """Write ``df`` as a columnar table under ``spark.checkpoint.dir`` and read
    it back: cuts the lineage so multi-pass consumers (model fits) do not
    recompute the raw scan, and a lost executor does not replay it either."""
    path = scratch_path(df.sparkSession, "tables", unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
