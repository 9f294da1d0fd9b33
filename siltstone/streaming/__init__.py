"""Incremental (Structured Streaming) operators."""
