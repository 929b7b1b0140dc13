"""Structured Streaming versions of the batch results."""
