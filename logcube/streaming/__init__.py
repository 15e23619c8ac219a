"""Incremental ingest of raw logs with Structured Streaming."""
