"""Structured Streaming front of the log operators."""
