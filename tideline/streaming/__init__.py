"""Structured Streaming jobs that merge a feed into a stored table."""
