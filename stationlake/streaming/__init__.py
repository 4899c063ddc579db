"""Structured Streaming ingest of queued sensor messages."""
