"""Structured Streaming queries and their handles."""
