"""Parsing and rendering expressions for accounting lines.

All helpers take and return ``Column`` so they stay inside whole-stage
codegen and work on streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accepted number and event-time shapes
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
EVENT_TIME_PATTERN = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?$"
# access node: ADSL = text before the last space that is followed by text;
# fibre = text before the first whitespace that is followed by text
ADSL_NODE_PATTERN = r"\A(.+) .+\z"
FIBER_NODE_PATTERN = r"\A(.+?)\s.+\z"
NO_ACCESS_NODE = "<NONE>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_long(c) -> Column:
    """Plain optional-sign integer text -> bigint; anything else (blank
    padding, decimals, words, empty, overflow) -> 0."""
    c = _col(c)
    return F.coalesce(F.when(c.rlike(INTEGER_PATTERN), c.try_cast("bigint")), F.lit(0).cast("bigint"))


def safe_int(c) -> Column:
    c = _col(c)
    return F.coalesce(F.when(c.rlike(INTEGER_PATTERN), c.try_cast("int")), F.lit(0))


def valid_event_time(c) -> Column:
    """True when the text is a full date and time (``/`` or ``-`` separated)
    that converts to a timestamp."""
    c = _col(c)
    return parse_event_time(c).isNotNull()


def parse_event_time(c) -> Column:
    """``yyyy/M/d H:m:s[.f]`` (or with ``-``) -> timestamp in the session zone."""
    c = _col(c)
    return F.when(c.rlike(EVENT_TIME_PATTERN), F.replace(c, F.lit("/"), F.lit("-")).try_cast("timestamp"))


def day_of(c) -> Column:
    """Text of the date field from its first space on (time of day with the
    leading space kept)."""
    c = _col(c)
    return F.substr(c, F.instr(c, " "))


def access_node_adsl(calling_station_id) -> Column:
    return F.nullif(F.regexp_extract(_col(calling_station_id), ADSL_NODE_PATTERN, 1), F.lit(""))


def access_node_fiber(circuit_id) -> Column:
    return F.nullif(F.regexp_extract(_col(circuit_id), FIBER_NODE_PATTERN, 1), F.lit(""))


def access_node(calling_station_id, circuit_id) -> Column:
    """ADSL rule first, then fibre rule, else ``<NONE>``."""
    return F.coalesce(access_node_adsl(calling_station_id), access_node_fiber(circuit_id),
                      F.lit(NO_ACCESS_NODE))


def epoch_millis(c) -> Column:
    return F.unix_millis(_col(c).cast("timestamp"))


def java_timestamp_string(c) -> Column:
    """Render like ``java.sql.Timestamp.toString``: ``yyyy-MM-dd HH:mm:ss.f``
    where the fraction has its trailing zeros removed but keeps one digit."""
    c = _col(c).cast("timestamp")
    micros = F.unix_micros(c) - F.unix_seconds(c) * F.lit(1_000_000)
    frac = F.when(micros == 0, F.lit("0")).otherwise(
        F.regexp_replace(F.lpad(micros.cast("string"), 6, "0"), "0+$", ""))
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."), frac)
