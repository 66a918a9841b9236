"""Structured Streaming over the landing zone, reusing the batch operators."""
