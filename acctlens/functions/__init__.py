"""Column-level functions (all JVM-side Spark expressions, no Python UDFs)."""

from acctlens.functions.scalars import (
    access_node, access_node_adsl, access_node_fiber, day_of, epoch_millis, java_timestamp_string,
    parse_event_time, safe_int, safe_long, valid_event_time,
)
from acctlens.functions.vectors import sq_distance, vector_to_array

__all__ = [
    "access_node", "access_node_adsl", "access_node_fiber", "day_of", "epoch_millis",
    "java_timestamp_string", "parse_event_time", "safe_int", "safe_long", "valid_event_time",
    "sq_distance", "vector_to_array",
]
