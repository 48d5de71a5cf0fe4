"""Pipelines composed of sources, operators and sinks."""
