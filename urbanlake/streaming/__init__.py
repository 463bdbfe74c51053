"""Structured Streaming ingest and table refresh."""
