"""Ingestion, lakehouse and streaming KPI operators for PySpark."""

__version__ = "0.1.0"
