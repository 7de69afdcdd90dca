"""Streaming ingest of log tables."""
