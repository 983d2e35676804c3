"""Streaming forms of the ingest and fill steps (Structured Streaming)."""
