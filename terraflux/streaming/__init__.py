"""Incremental runs of stateless stages with Structured Streaming."""
