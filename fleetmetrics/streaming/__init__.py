"""Structured Streaming versions of ingestion and status."""
