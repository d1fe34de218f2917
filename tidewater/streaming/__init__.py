"""Structured Streaming forms of the micro-batch flows."""
