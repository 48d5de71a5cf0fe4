"""Tables that are replaced as a whole, one directory per version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.change_data import upsert
from tidemark.sinks import paths
from tidemark.sinks.batch import enforce_schema


class SnapshotTable:
    """A path holding numbered versions; readers get the newest complete one.

    A version counts once Spark has put ``_SUCCESS`` into it, so nobody sees half
    a write, and writing a number again (a replayed micro-batch) replaces it.
    There must be one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep

    def versions(self) -> list[int]:
        found = []
        for name in paths.children(self.spark, self.path):
            if name.startswith("v="):
                if paths.exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                    found.append(int(name[2:]))
        return sorted(found)

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest version, or the newest one below ``before``; None if there is none."""
        usable = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.path}/v={usable[-1]}") if usable else None

    def write(self, df: DataFrame, version: int | None = None, replace_schema: bool = False) -> int:
        """Write a version; one with other columns or types than the one before only if that is said."""
        present = self.versions()
        before = [v for v in present if version is None or v < version]
        if before and not replace_schema:
            enforce_schema(df, self.spark.read.parquet(f"{self.path}/v={before[-1]}").schema)
        if version is None:
            version = present[-1] + 1 if present else 0
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        # older ones stay for readers that have just resolved them
        for old in [v for v in present if v < version][: -self.keep]:
            paths.delete(self.spark, f"{self.path}/v={old}")
        return version

    def merge(self, source: DataFrame, keys: Sequence[str], version: int | None = None) -> int:
        """Upsert by key into the version before ``version`` and write the result as ``version``."""
        current = self.read(before=version)
        return self.write(source if current is None else upsert(current, source, keys), version)
