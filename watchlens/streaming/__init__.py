"""Structured Streaming queries, sinks and metrics."""
