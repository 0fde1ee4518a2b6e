"""Structured Streaming pipelines and their per-batch sinks."""
