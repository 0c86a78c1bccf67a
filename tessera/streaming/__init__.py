"""Structured Streaming sources, parsers, stateful aggregates and per-batch sinks."""
