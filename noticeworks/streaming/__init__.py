"""Incremental entry points on Structured Streaming."""
