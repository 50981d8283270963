"""Structured Streaming ingest into the two bronze tables."""
