"""Incremental ingest of filings with Structured Streaming."""
