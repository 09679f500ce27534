"""Adapter: driver ``events`` rows -> 28-field accounting lines.

The driver's tables hold no accounting records, so each event is rendered to
one comma-separated line with pure column expressions (one narrow projection,
no shuffle).  A few deterministic variants exercise the parser: unparsable
session times, decimal counters, truncated lines and dates without a time.
The same rules are written in SQL in ``acctlens.plans.oracle``.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlens.session import prepare, scratch_path

# fixed values: event type -> accounting status
STATUS_BY_EVENT = {"view": "Alive", "click": "Alive", "error": "Stop", "purchase": "Stop",
                   "signup": "Start"}
N_SERVERS = 10
N_CAUSES = 5
# rows whose event_id is a multiple of these get the variant shapes
BAD_SESSION_TIME_EVERY = 97
DECIMAL_OCTETS_EVERY = 53
TRUNCATED_LINE_EVERY = 211
DATE_ONLY_EVERY = 223


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def status_of(event_type: Column) -> Column:
    expr = None
    for k, v in STATUS_BY_EVENT.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr.otherwise(event_type)


def line_fields(ev: DataFrame | None = None) -> list[Column]:
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    status = status_of(F.col("event_type"))
    server = uid % N_SERVERS
    k = F.coalesce(F.regexp_extract(F.col("props"), "[0-9]+", 0).try_cast("bigint"), F.lit(0))
    session_time = F.when(eid % BAD_SESSION_TIME_EVERY == 0, F.lit("bad")).otherwise(_s((eid * 7) % 3600))
    out_octets = F.when(eid % DECIMAL_OCTETS_EVERY == 0, F.concat(_s(eid % 100000), F.lit(".5"))) \
        .otherwise(_s(eid % 100000))
    return [
        F.date_format(ts, "yyyy/MM/dd HH:mm:ss"),                       # 0 date
        _s(F.unix_seconds(ts.cast("timestamp"))),                        # 1 epoch seconds
        status,                                                          # 2 status type
        F.concat(F.lit("S"), _s(eid)),                                   # 3 session id
        session_time,                                                    # 4 session time
        out_octets,                                                      # 5 output octets
        _s(eid % 4),                                                     # 6 output gigawords
        _s((eid * 3) % 100000),                                          # 7 input octets
        _s(eid % 2),                                                     # 8 input gigawords
        _s(eid % 1000),                                                  # 9 output packets
        _s(eid % 500),                                                   # 10 input packets
        F.concat(F.lit("bras"), _s(server)),                             # 11 NAS identifier
        F.concat(F.lit("10.0.0."), _s(server)),                          # 12 NAS IP address
        _s(uid % 48),                                                    # 13 NAS port
        F.concat(F.lit("C"), _s(uid)),                                   # 14 client id
        _s(uid % 3),                                                     # 15 access type
        F.concat(F.lit("user"), _s(uid)),                                # 16 user name
        F.when(eid % 3 == 0, F.concat(F.lit("NODE"), _s(uid % 5), F.lit(" atm 0/1")))
         .otherwise(F.lit("nospace")),                                   # 17 calling station
        F.when(eid % 3 == 1, F.concat(F.lit("OLT"), _s(uid % 5), F.lit(" xpon 0/2")))
         .otherwise(F.lit("")),                                          # 18 circuit id
        F.lit("rem"),                                                    # 19 remote id
        F.concat(F.lit("100.64.0."), _s(uid % 250)),                     # 20 framed IP
        F.lit("conn"),                                                   # 21 connect info
        F.when(status == "Stop", F.concat(F.lit("cause"), _s(k % N_CAUSES))).otherwise(F.lit("")),  # 22
        F.lit("0"), F.lit("0"), F.lit("0"), F.lit(""),                   # 23-26 NAT / delay
        F.concat(F.lit("mac"), _s(uid)),                                 # 27 user mac
    ]


def events_to_lines(events: DataFrame, keep_id: bool = False) -> DataFrame:
    """``events`` -> ``value`` string lines (optionally with ``event_id``).

    One array of the 28 fields, joined once; the variants only change field 0
    and the slice length, which keeps the generated code small."""
    eid = F.col("event_id")
    fields = line_fields()
    date_only = (eid % DATE_ONLY_EVERY == 0) & (eid % TRUNCATED_LINE_EVERY != 0)
    fields[0] = F.when(date_only, F.date_format(F.col("ts"), "yyyy/MM/dd")).otherwise(fields[0])
    n = F.when(eid % TRUNCATED_LINE_EVERY == 0, F.lit(5)).otherwise(F.lit(len(fields)))
    value = F.array_join(F.slice(F.array(*[F.coalesce(c, F.lit("")) for c in fields]), 1, n), ",")
    cols = ([eid] if keep_id else []) + [value.alias("value")]
    return events.select(*cols)


LINE_FILES = 8


def _fs_status(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _listing(fs, p) -> list[str]:
    """``path|size|modification time`` of every file at or under ``p``."""
    out, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    return sorted(out)


def event_lines_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of text lines rendered from ``events`` (the recorded line
    files a deployment reads from a topic or folder).  Written once per
    version of the events table - the key covers every file of it - under the
    shared checkpoint root; every query then reads plain text lines, as it
    would in production.  Files follow each other in event time, by name and by
    modification time, so a file stream delivers them in order."""
    fs, p = _fs_status(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    key = hashlib.sha1("\n".join([fs.makeQualified(p).toString(), "v3", *_listing(fs, p)]).encode()).hexdigest()[:16]
    out = scratch_path(spark, f"event_lines/{key}")
    ofs, target = _fs_status(spark, out)
    if not ofs.exists(target):
        n = max(LINE_FILES, spark.sparkContext.defaultParallelism)
        events = read_events(spark, sf_dir).repartitionByRange(n, "ts", "event_id").sortWithinPartitions("ts", "event_id")
        # hidden name (leading "_"): if a concurrent writer published first and
        # the rename nests this folder inside the target, readers skip it
        staging = f"{scratch_path(spark, 'event_lines')}/_staging_{key}_{uuid.uuid4().hex}"
        events_to_lines(events).write.mode("overwrite").text(staging)
        _, sp = _fs_status(spark, staging)
        parts = sorted(x.split("|")[0] for x in _listing(ofs, sp))
        for i, part in enumerate(x for x in parts if "/part-" in x):
            _, pp = _fs_status(spark, part)
            ofs.setTimes(pp, 1_700_000_000_000 + 1000 * i, -1)
        # publish atomically; a concurrent writer that won the rename wins
        if not ofs.rename(sp, target) and not ofs.exists(target):
            raise RuntimeError(f"could not publish {staging} to {out}")
    return out


def read_event_lines(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    prepare(spark)
    path = event_lines_path(spark, sf_dir)
    return (spark.readStream if streaming else spark.read).format("text").load(path)
