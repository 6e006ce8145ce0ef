"""Structured Streaming sources, event-time aggregation, sessions and sinks."""
