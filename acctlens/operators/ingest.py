"""Accounting line -> typed columns, plus a quarantine for malformed lines.

Parsing is one ``split`` and per-field native expressions, so Catalyst prunes
fields a query never reads and pushes later filters through the projection.
A line is *accepted* when it has at least 28 fields and a full date+time in
field 0; everything else goes to :func:`quarantine` (the reference kills the
stream on such lines).  Present-but-empty fields stay ``""``; ``strict=True``
first strips trailing empty fields the way a JVM ``split(",")`` does, so a
line with an empty last field is quarantined as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlens.functions.scalars import (
    access_node, day_of, parse_event_time, safe_int, safe_long, valid_event_time,
)
from acctlens.schema import (
    CDR22_POSITIONS, FIELD_KINDS_28, FIELD_NAMES_28, N_FIELDS, RADIUS_NAMES_28,
)

_FIELDS = "_fields"


def _source(value: str, strict: bool) -> Column:
    v = F.col(value)
    return F.regexp_replace(v, ",+$", "") if strict else v


def _n_fields(v: Column) -> Column:
    """Field count from the comma count: no split needed to decide."""
    return F.length(v) - F.length(F.replace(v, F.lit(","), F.lit(""))) + 1


def _accepted(v: Column) -> Column:
    """At least 28 fields and a full date+time in field 0.  Evaluated on the
    raw line (it is the filter Catalyst pushes to the scan)."""
    return (_n_fields(v) >= N_FIELDS) & valid_event_time(F.substring_index(v, ",", 1))


def _split(df: DataFrame, value: str, strict: bool, keep: list[str], accepted: bool) -> DataFrame:
    v = _source(value, strict)
    ok = _accepted(v)
    df = df.filter(ok if accepted else ~ok)
    return df.select(*keep, F.col(value).alias("_line"), F.split(v, ",", -1).alias(_FIELDS))


def _f(i: int) -> Column:
    return F.get(F.col(_FIELDS), i)


def _typed(i: int, kind: str) -> Column:
    raw = _f(i)
    if kind == "ts":
        return parse_event_time(raw)
    if kind == "long":
        return safe_long(raw)
    if kind == "int":
        return safe_int(raw)
    return raw


def cdr_columns(layout: str = "cdr24") -> list[Column]:
    """Typed columns of the accepted line, by layout: ``cdr24`` (22 raw +
    ``accessNode`` + ``day``), ``cdr22`` (tuple form) or ``cdr28`` (all)."""
    if layout == "cdr28":
        return [_typed(i, k).alias(FIELD_NAMES_28[i]) for i, k in enumerate(FIELD_KINDS_28)]
    cols = [_typed(i, "str" if i == 15 else FIELD_KINDS_28[i]).alias(FIELD_NAMES_28[i])
            for i in CDR22_POSITIONS]
    if layout == "cdr22":
        return cols
    if layout == "cdr24":
        return cols + [access_node(_f(17), _f(18)).alias("accessNode"), day_of(_f(0)).alias("day")]
    raise ValueError(f"unknown layout {layout!r}")


def parse_cdr(lines: DataFrame, layout: str = "cdr24", strict: bool = False, value: str = "value",
              keep: list[str] | None = None) -> DataFrame:
    """Accepted lines as typed records.  ``keep`` passes columns through
    (e.g. an id or a source file)."""
    keep = keep or []
    return _split(lines, value, strict, keep, True).select(*keep, *cdr_columns(layout))


def parse_cdr_full(lines: DataFrame, strict: bool = False, radius_names: bool = False, **kw) -> DataFrame:
    """28-column form; ``radius_names`` renames to RADIUS attribute names."""
    df = parse_cdr(lines, "cdr28", strict, **kw)
    if radius_names:
        df = df.withColumnsRenamed(dict(zip(FIELD_NAMES_28, RADIUS_NAMES_28)))
    return df


def cdr_tuple22(lines: DataFrame, strict: bool = False, **kw) -> DataFrame:
    return parse_cdr(lines, "cdr22", strict, **kw)


def quarantine(lines: DataFrame, strict: bool = False, value: str = "value",
               keep: list[str] | None = None) -> DataFrame:
    """Rejected lines with the reason: ``too_few_fields`` or ``bad_date``."""
    keep = keep or []
    df = _split(lines, value, strict, keep, False)
    reason = F.when(F.size(F.col(_FIELDS)) < N_FIELDS, F.lit("too_few_fields")).otherwise(F.lit("bad_date"))
    return df.select(*keep, F.col("_line").alias(value), F.size(F.col(_FIELDS)).alias("n_fields"),
                     reason.alias("reason"))


def parse_agg_line(lines: DataFrame, n_keys: int, value: str = "value") -> DataFrame:
    """``aggName,timestamp,aggField1..n,value`` -> first-order rows
    (``aggName, timestamp, value, aggField1..n``); a bad value parses as 0."""
    if not 1 <= n_keys <= 4:
        raise ValueError("aggregate lines have 1 to 4 key fields")
    f = F.split(F.col(value), ",", -1)
    cols = [F.get(f, 0).alias("aggName"), F.get(f, 1).try_cast("timestamp").alias("timestamp"),
            safe_long(F.get(f, n_keys + 2)).alias("value")]
    cols += [F.get(f, i + 1).alias(f"aggField{i}") for i in range(1, n_keys + 1)]
    return lines.select(*cols)
