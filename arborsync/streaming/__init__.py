"""Structured Streaming jobs: change feed, latest versions, retry queue."""
