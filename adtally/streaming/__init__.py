"""Streaming forms of the polled counters."""
