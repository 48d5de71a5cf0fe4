"""Event-time windows and deduplication. All work on batch DataFrames as well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELAY = "10 minutes"  # how late an event may arrive


def _windowed(df: DataFrame, ts: str, delay: str, window: Column, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    if df.isStreaming:
        df = df.withWatermark(ts, delay)
    grouped = df.groupBy(window.alias("_w"), *keys).agg(*aggregates)
    ends = [F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")]
    return grouped.select(*ends, *[c for c in grouped.columns if c != "_w"])


def tumbling(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], aggregates: Sequence[Column], delay: str = DELAY
) -> DataFrame:
    """Aggregates per fixed window; a window is final once the watermark passes its end."""
    return _windowed(df, ts, delay, F.window(ts, size), keys, aggregates)


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], aggregates: Sequence[Column],
    delay: str = DELAY,
) -> DataFrame:
    """Aggregates per overlapping window; each event counts in size / slide windows."""
    return _windowed(df, ts, delay, F.window(ts, size, slide), keys, aggregates)


def sessions(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggregates: Sequence[Column], delay: str = DELAY
) -> DataFrame:
    """Aggregates per session: events of a key at most ``gap`` apart."""
    return _windowed(df, ts, delay, F.session_window(ts, gap), keys, aggregates)


def deduplicate(df: DataFrame, keys: Sequence[str], ts: str, delay: str = DELAY, untimed: bool = False) -> DataFrame:
    """One row per business key; state is kept only as long as copies may still arrive.

    No watermark can tell when copies of a row without a time end. Such rows all
    pass, unless ``untimed``: then their keys are remembered for good, by a second
    reading of the source.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    if not untimed:
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    timed = df.withWatermark(ts, delay).where(F.col(ts).isNotNull()).dropDuplicatesWithinWatermark(list(keys))
    return timed.union(df.where(F.col(ts).isNull()).dropDuplicates(list(keys)))
