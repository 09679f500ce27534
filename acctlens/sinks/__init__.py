"""Sinks: message topics, document tables, batch-idempotent table writes."""
