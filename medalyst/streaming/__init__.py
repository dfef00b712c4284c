"""Structured Streaming forms of the ingest, gate and demand jobs."""
