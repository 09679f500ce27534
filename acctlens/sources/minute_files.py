"""Minute-partitioned line folders (replay input).

Two layouts are read:

* ``reference``: ``<root>/<leaf>/cdr.<yyyy-MM-ddTHH-mm>.txt``; the minutes that
  are present come from the file listing, empty files included.
* ``partitioned``: what :func:`write_minute_files` writes with Spark,
  ``<root>/lines/leaf=<leaf>/day=<yyyy-MM-dd>/part-*`` with the present (leaf,
  minute) pairs as a table of their own in ``<root>/minutes``; a line's minute comes
  from its date field and ``day`` gives partition pruning.

Replay semantics: per leaf, minutes are read in order from ``start`` on and
reading stops once more than ``max_missing`` consecutive minutes have no
file.  That is computed over the (leaf, minute) pairs - one small row per file -
and gives one row per leaf; the lines are read once and never shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlens.functions.scalars import parse_event_time
from acctlens.operators.asof import asof_latest
from acctlens.session import materialize

FILE_MINUTE_FORMAT = "yyyy-MM-dd'T'HH-mm"
DEFAULT_MAX_MISSING = 20
UNASSIGNED_LEAF = "unassigned"
MAX_BROADCAST_LEAVES = 100_000


def parse_start_minute(start: str) -> dt.datetime:
    return dt.datetime.strptime(start, "%Y-%m-%dT%H-%M")


def _line_minute(value):
    return F.date_trunc("minute", parse_event_time(F.get(F.split(value, ",", -1), 0)))


def write_minute_files(lines: DataFrame, root: str, leaf_position: int = 11, present: DataFrame | None = None) -> int:
    """Write lines as ``leaf=/day=`` text folders and the minutes they cover;
    returns how many lines have no parsable date.  Those go to ``<root>/undated``
    and are never replayed.

    The leaf is the line's field ``leaf_position`` (NAS identifier).  ``present``:
    further (leaf, minute) pairs that count as present although they hold no
    line.  The REBALANCE hint lets AQE coalesce small folders into one file
    and split a hot leaf/day over several writer tasks."""
    fields = F.split(F.col("value"), ",", -1)
    leaf = F.coalesce(F.nullif(F.get(fields, leaf_position), F.lit("")), F.lit(UNASSIGNED_LEAF))
    rows = lines.select("value", leaf.alias("leaf"), _line_minute(F.col("value")).alias("minute"))
    dated = rows.filter("minute is not null")
    (dated.select("value", "leaf", F.to_date("minute").alias("day")).hint("rebalance", "leaf", "day")
     .write.mode("overwrite").partitionBy("leaf", "day").text(f"{root}/lines"))
    minutes = dated.select("leaf", "minute")
    if present is not None:
        minutes = minutes.unionByName(present.select("leaf", "minute"))
    minutes.distinct().write.mode("overwrite").parquet(f"{root}/minutes")
    rows.filter("minute is null").select("value").write.mode("overwrite").text(f"{root}/undated")
    return lines.sparkSession.read.text(f"{root}/undated").count()


def name_parts(path):
    """leaf and minute of a file's path."""
    leaf = F.regexp_extract(path, r"/([^/]+)/cdr\.[^/]*$", 1)
    minute = F.to_timestamp(F.regexp_extract(path, r"cdr\.([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}-[0-9]{2})\.txt$", 1),
                            FILE_MINUTE_FORMAT)
    return leaf.alias("leaf"), minute.alias("minute")


def minute_paths(spark: SparkSession, root: str) -> DataFrame:
    """(leaf, minute, path) of each file of the reference layout.  Scans skip empty files,
    whose presence counts here, so names come from the listing that a scan begins
    with; like there, it passes through the driver."""
    files = spark.read.text(f"{root.rstrip('/')}/*/cdr.*.txt").inputFiles()
    return spark.createDataFrame([(x,) for x in files], "path string").select(*name_parts(F.col("path")), "path")


def present_minutes(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """(leaf, minute) with a file."""
    root = root.rstrip("/")
    if layout == "reference":
        return minute_paths(spark, root).select("leaf", "minute").distinct()
    if layout == "partitioned":
        return spark.read.schema("leaf string, minute timestamp").parquet(f"{root}/minutes")
    raise ValueError(f"unknown minute-file layout {layout!r}")


def dated_lines(spark: SparkSession, root: str, since: dt.date) -> DataFrame:
    """leaf, day, minute, value of the partitioned layout, from a day on (partition pruning)."""
    df = spark.read.schema("value string, leaf string, day date").text(f"{root}/lines")
    return df.filter(F.col("day") >= F.lit(since)).select("leaf", "day", _line_minute(F.col("value")).alias("minute"), "value")


def _lines(spark: SparkSession, root: str, layout: str, start: dt.datetime) -> DataFrame:
    root = root.rstrip("/")
    if layout == "reference":
        df = spark.read.text(f"{root}/*/cdr.*.txt").select("value", F.col("_metadata.file_path").alias("_p"))
        return df.select(*name_parts(F.col("_p")), "value")
    return dated_lines(spark, root, start.date()).select("leaf", "minute", "value")


def replay_cutoffs(minutes: DataFrame, start: dt.datetime, max_missing: int = DEFAULT_MAX_MISSING) -> DataFrame:
    """(leaf, minute) present -> (leaf, stop_minute): the first minute that
    follows more than ``max_missing`` missing minutes (the first present
    minute is compared with ``start``).  Leaves that never stop have no row.

    A minute m stops the replay iff no earlier present minute (or the
    virtual ``start - 1 minute``) lies in ``[m - max_missing - 1, m - 1]``.
    That is a bounded as-of lookup (buckets of ``max_missing + 1`` minutes),
    so no task holds a leaf's whole history."""
    span = (max_missing + 1) * 60
    before_start = minutes.select("leaf").distinct().select(
        "leaf", (F.lit(start) - F.expr("INTERVAL 1 MINUTE")).alias("minute"))
    present = minutes.select("leaf", "minute").unionByName(before_start) \
        .select("leaf", F.col("minute").alias("prevMinute"))
    probe = minutes.select("leaf", "minute", (F.col("minute") - F.expr("INTERVAL 1 MINUTE")).alias("_probe"))
    found = asof_latest(probe, present, ["leaf"], "_probe", "prevMinute", span, bucket_seconds=span, how="left")
    return (found.filter(F.col("prevMinute").isNull())
            .groupBy("leaf").agg(F.min("minute").alias("stop_minute")))


def minute_file_lines(spark: SparkSession, root: str, start: str, layout: str = "partitioned",
                      max_missing: int = DEFAULT_MAX_MISSING) -> DataFrame:
    """Lines a replay from ``start`` (``yyyy-MM-ddTHH-mm``) would publish:
    ``leaf, minute, value``."""
    start_ts = parse_start_minute(start)
    minutes = materialize(present_minutes(spark, root, layout).filter(F.col("minute") >= F.lit(start_ts)))
    stops = materialize(replay_cutoffs(minutes, start_ts, max_missing))
    lines = _lines(spark, root, layout, start_ts).filter(F.col("minute") >= F.lit(start_ts))
    if stops.count() <= MAX_BROADCAST_LEAVES:  # a row per leaf; else Spark picks the join
        stops = F.broadcast(stops)
    return (lines.join(stops, "leaf", "left")
            .filter(F.col("stop_minute").isNull() | (F.col("minute") < F.col("stop_minute")))
            .select("leaf", "minute", "value"))
