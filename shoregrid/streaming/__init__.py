"""Structured Streaming forms of the near-real-time loads."""
