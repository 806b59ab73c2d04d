"""Structured Streaming forms of unpacking, profiling, sync and the drift gate."""
