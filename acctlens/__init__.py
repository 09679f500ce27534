"""acctlens: session-accounting (RADIUS CDR) analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so the same definition runs on batch tables and on Structured
Streaming inputs.  See README.md for the module map.
"""

from acctlens.config import AnalyzerConfig, SCALED_CONFIG

__all__ = ["AnalyzerConfig", "SCALED_CONFIG"]
