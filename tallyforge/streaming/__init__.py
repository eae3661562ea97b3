"""Structured Streaming jobs: running counts, per-key state, keyed upsert."""
