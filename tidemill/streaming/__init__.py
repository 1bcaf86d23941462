"""Structured Streaming: load new files as they land."""
