"""Structured Streaming ingestion of landing folders."""
