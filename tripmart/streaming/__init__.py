"""Structured Streaming: event source, zone counts, keyed upserts."""
