"""Structured Streaming wiring: sources, chained windowed aggregation,
``foreachBatch`` multi-sinks and the micro-batch cause-mix model."""
