"""Batch and streaming writers."""
