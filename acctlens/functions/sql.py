"""The record parser as a temporary SQL function, for SQL text over lines.

``toCDRItems(line)`` is a SQL expression (no Python): a struct of the 22 items of an
accepted line, null for a line that the quarantine would take.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from acctlens.functions.scalars import EVENT_TIME_PATTERN, INTEGER_PATTERN
from acctlens.schema import CDR22_POSITIONS, FIELD_KINDS_28, FIELD_NAMES_28, N_FIELDS

_TYPES = {"ts": "TIMESTAMP", "long": "BIGINT", "int": "STRING", "str": "STRING"}


def _time(field: str) -> str:
    return f"CASE WHEN rlike({field}, r'{EVENT_TIME_PATTERN}') THEN try_cast(replace({field}, '/', '-') AS TIMESTAMP) END"


def _item(position: int) -> str:
    field, kind = f"get(f, {position})", FIELD_KINDS_28[position]
    if kind == "ts":
        return _time(field)
    if kind == "long":
        return f"coalesce(CASE WHEN rlike({field}, r'{INTEGER_PATTERN}') THEN try_cast({field} AS BIGINT) END, 0L)"
    return field


def to_cdr_items_sql(name: str = "toCDRItems") -> str:
    """The statement that makes the function."""
    items = [(FIELD_NAMES_28[i], _TYPES[FIELD_KINDS_28[i]], _item(i)) for i in CDR22_POSITIONS]
    struct = ", ".join(f"'{n}', {e}" for n, _, e in items)
    accepted = f"size(f) >= {N_FIELDS} AND {_time('get(f, 0)')} IS NOT NULL"
    # the split is made once and passed on as f
    body = f"element_at(transform(array(split(line, ',', -1)), f -> CASE WHEN {accepted} THEN named_struct({struct}) END), 1)"
    returns = ", ".join(f"{n}: {t}" for n, t, _ in items)
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(line STRING) RETURNS STRUCT<{returns}> RETURN {body}"


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``toCDRItems`` known to this session (streams started later have it too)."""
    spark.sql(to_cdr_items_sql())
