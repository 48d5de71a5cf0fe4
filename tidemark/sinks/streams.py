"""Streaming writers: files, tables, and whole-table snapshots."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.sinks.parts import PartTable, upsert_rows
from tidemark.sinks.snapshot import SnapshotTable

TRIGGERS = ("processingTime", "availableNow")


def with_trigger(writer: DataStreamWriter, trigger: str = "processingTime", interval: str = "10 seconds") -> DataStreamWriter:
    """``availableNow`` drains what is there and ends; ``processingTime`` runs until stopped."""
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "processingTime":
        return writer.trigger(processingTime=interval)
    raise ValueError(f"trigger must be one of {TRIGGERS}, not {trigger}")


def checkpoint_for(base: str, sink: str) -> str:
    """A checkpoint folder per sink.

    The digest keeps sinks apart whose names differ only in characters that a
    folder name cannot hold, such as ``a/b`` and ``a_b``.
    """
    readable = re.sub(r"[^0-9A-Za-z]+", "_", sink).strip("_")[-60:]
    return f"{base.rstrip('/')}/{readable}-{hashlib.sha256(sink.encode()).hexdigest()[:10]}"


def append_to_path(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: str = "processingTime",
    interval: str = "10 seconds", partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to files; the sink's log makes restarts exactly-once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, trigger, interval).start(path)


def append_to_table(
    df: DataFrame, name: str, checkpoint: str, path: str | None = None, fmt: str = "parquet",
    trigger: str = "processingTime", interval: str = "10 seconds",
) -> StreamingQuery:
    """Append to a catalog table, created on first use (external when a path is given)."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    return with_trigger(writer, trigger, interval).toTable(name)


def each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], mode: str, checkpoint: str,
    trigger: str = "processingTime", interval: str = "10 seconds",
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``, which must be repeatable."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return with_trigger(writer, trigger, interval).start()


def replace_snapshot(df: DataFrame, table: SnapshotTable, checkpoint: str, **trigger: str) -> StreamingQuery:
    """Complete mode: every micro-batch writes the whole result as the version of its number."""

    def write(batch: DataFrame, number: int) -> None:
        table.write(batch, number)

    return each_batch(df, write, "complete", checkpoint, **trigger)


def upsert_parts(df: DataFrame, table: PartTable, keys: Sequence[str], checkpoint: str, **trigger: str) -> StreamingQuery:
    """Update mode: changed rows replace those of equal key, in the parts that their keys belong to.

    Other parts are neither read nor written. A replayed batch starts from the
    version before its number again, so it does not apply its rows twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # used for the parts and for the rows
        try:
            table.merge(batch, upsert_rows(keys), number)
        finally:
            batch.unpersist()

    return each_batch(df, write, "update", checkpoint, **trigger)


def upsert_snapshot(
    df: DataFrame, table: SnapshotTable, keys: Sequence[str], checkpoint: str, **trigger: str
) -> StreamingQuery:
    """Update mode for a small table, which is rewritten whole; ``upsert_parts`` is for others.

    A replayed batch starts from the version before its number again, so it does
    not apply its rows twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # used for the keys and for the rows
        try:
            table.merge(batch, keys, number)
        finally:
            batch.unpersist()

    return each_batch(df, write, "update", checkpoint, **trigger)
