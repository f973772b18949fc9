"""Structured Streaming forms of the live-state jobs."""
