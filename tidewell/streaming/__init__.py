"""Incremental file processing with Structured Streaming."""
