"""Incremental ingest as Structured Streaming."""
