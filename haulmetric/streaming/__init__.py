"""Structured Streaming sinks and the chained bronze -> silver -> gold run."""
