"""Structured Streaming jobs: raw log, entity state, metric tables."""
