"""Vector helpers on ``array<double>`` columns (SQL-visible form of ML vectors)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array as _vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_to_array(c) -> Column:
    return _vector_to_array(F.col(c) if isinstance(c, str) else c, "float64")


def sq_distance(a, b) -> Column:
    """Squared Euclidean distance of two equal-length ``array<double>``."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)
