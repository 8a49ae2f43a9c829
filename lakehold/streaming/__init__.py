"""Structured Streaming: the access-event file queue into Bronze, live counts by type."""
