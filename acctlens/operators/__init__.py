"""DataFrame operators (batch and streaming unless noted)."""
