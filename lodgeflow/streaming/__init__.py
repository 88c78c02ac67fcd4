"""Incremental ingestion of newly arriving raw files (Structured Streaming)."""
