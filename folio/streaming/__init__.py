"""Structured Streaming ingestion of the landing feeds."""
