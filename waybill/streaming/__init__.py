"""Structured Streaming jobs: ingest, dedup, windows, late split, enrichment."""
