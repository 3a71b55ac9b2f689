"""Incremental ingestion of landing files with Structured Streaming."""
