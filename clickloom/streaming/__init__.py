"""Structured Streaming jobs, sinks and stateful operators."""
