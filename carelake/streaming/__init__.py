"""Structured Streaming: incremental file ingestion into bronze."""
