"""One-off drain of a directory into a table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

from tidemark.streaming.ingester import FileIngester, IngestConfig


def run_file_ingest(spark: SparkSession, config: IngestConfig, table_name: str) -> dict[str, Any]:
    """Ingest every file that is there now, then return the status of the query."""
    ingester = FileIngester(spark, config)
    ingester.write_to_table(table_name=table_name, trigger_type="availableNow")
    ingester.await_termination()
    return ingester.get_stream_status()


def run_together(ingesters: list[tuple[FileIngester, str]], timeout: float | None = None) -> bool:
    """Drain several ingests at once, each into its own table."""
    from tidemark.streaming.progress import await_all

    started = [i.write_to_table(table_name=name, trigger_type="availableNow") for i, name in ingesters]
    return await_all(started, timeout)
