"""Replay of recorded lines with re-based event time, as a batch/stream job.

The reference replays minute files in wall-clock time: a record with date
``d`` is released when ``start_real + (now - start_real) * factor >= d +
(start_real - start_replay)`` and re-stamped with ``now``.  The release time
is therefore a pure function of the record:

    release = greatest(start_real, start_real + (d - start_replay) / factor)

(a record dated before the replay start is due at once), so the replay becomes one projection (no sleeping threads) and the waiting
is left to whatever consumes the published stream.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.functions.scalars import parse_event_time

# fixed values: replay date formats
LINE_DATE_FORMAT = "yyyy/MM/dd HH:mm:ss"


MIN_FIELDS = 13


def _line_fields(value: str, strict: bool):
    return F.split(F.regexp_replace(F.col(value), ",+$", "") if strict else F.col(value), ",", -1)


def _micros(t: dt.datetime) -> int:
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 + t.microsecond


def rebase_lines(lines: DataFrame, start_replay: dt.datetime, start_real: dt.datetime, factor: int = 1,
                 change_date: bool = True, strict: bool = False, value: str = "value") -> DataFrame:
    """Adds ``releaseTime`` and the re-stamped ``value`` (field 0 replaced
    by the release time, second precision, unless ``change_date=False``).
    Records dated before ``start_replay`` are released at ``start_real``.
    Lines without a parsable date or with fewer than ``MIN_FIELDS`` fields (the
    reference aborts on them) are what :func:`replay_quarantine` returns.  ``strict`` re-joins the fields the
    way a JVM ``split`` leaves them (trailing empty fields removed)."""
    if factor <= 0:
        raise ValueError("factor must be positive")
    fields = _line_fields(value, strict)
    d = parse_event_time(F.get(fields, 0))
    release_us = F.lit(_micros(start_real)) + F.expr(f"(unix_micros(`_d`) - {_micros(start_replay)}) div {factor}")
    staged = lines.select(*[c for c in lines.columns if c != value], fields.alias("_fields"), d.alias("_d"))
    staged = staged.filter(F.col("_d").isNotNull() & (F.size("_fields") >= MIN_FIELDS))
    release = F.timestamp_micros(F.greatest(release_us, F.lit(_micros(start_real))))
    first = F.date_format(release, LINE_DATE_FORMAT) if change_date else F.get(F.col("_fields"), 0)
    rest = F.slice(F.col("_fields"), 2, F.size("_fields") - 1)
    out = F.array_join(F.concat(F.array(first), rest), ",")
    return staged.select(*[c for c in lines.columns if c != value], release.alias("releaseTime"),
                         out.alias(value), F.col("_fields"))


def replay_quarantine(lines: DataFrame, strict: bool = False, value: str = "value") -> DataFrame:
    """Lines a replay can't publish, with the reason: ``too_few_fields`` (the
    message key needs field 12) or ``bad_date``."""
    fields = _line_fields(value, strict)
    short = F.coalesce(F.size(fields) < MIN_FIELDS, F.lit(True))
    reason = F.when(short, "too_few_fields").when(parse_event_time(F.get(fields, 0)).isNull(), "bad_date")
    return (lines.select(F.col(value).alias(value), F.size(fields).alias("n_fields"), reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def publish_records(rebased: DataFrame, value: str = "value") -> DataFrame:
    """Message ``key`` = NAS IP + ``-`` + session id + ``-`` + session time
    (fields 12, 3, 4) and the line as ``value``."""
    f = F.col("_fields")
    key = F.concat_ws("-", F.get(f, 12), F.get(f, 3), F.get(f, 4))
    return rebased.select(key.alias("key"), F.col(value).alias("value"), "releaseTime")
