"""Structured Streaming jobs; each has a batch twin in operators."""
