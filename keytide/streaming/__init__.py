"""Streaming ingest into keyed tables."""
