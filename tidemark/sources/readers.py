"""Batch readers: files, databases, and reads since the last run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks import paths


def read_files(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Read csv, json, parquet or orc; CSV files have a header and the export dialect.

    Text with line breaks inside a CSV field needs ``multiLine=True``, which gives
    up splitting a file between tasks.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        dialect = {"header": True, "escape": '"', "nullValue": "\\N"}
        options = dialect | options
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def convert_files(
    spark: SparkSession, source: str, fmt: str, target: str, schema: T.StructType | str | None = None, **options
) -> None:
    """Source format to snappy parquet."""
    read_files(spark, source, fmt, schema, **options).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(target)


def jdbc_options(
    url: str, table: str, column: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Options of a JDBC read split in ``partitions`` ranges of ``column``.

    The bounds set the stride only: rows outside them are still read, by the
    first and last partition.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        **connection,
    }


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A database table; filters and column lists are pushed to the database."""
    return spark.read.format("jdbc").options(**options).load()


def since(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows newer than the high-water mark; a file scan gets the filter pushed down."""
    return df if mark is None else df.where(F.col(column) > mark)


def undated(df: DataFrame, column: str) -> DataFrame:
    """Rows that no high-water mark can place."""
    return df.where(F.col(column).isNull())


class HighWaterMark:
    """The newest value loaded so far, one small file per run under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _runs(self) -> list[int]:
        return sorted(int(n[:-4]) for n in paths.children(self.spark, self.path) if n.endswith(".txt"))

    def value(self) -> str | None:
        runs = self._runs()
        return paths.read_small(self.spark, f"{self.path}/{runs[-1]}.txt") if runs else None

    def read(
        self, df: DataFrame, column: str, loaded: DataFrame | None = None, keys: Sequence[str] = ()
    ) -> DataFrame:
        """Rows of ``df`` that no committed run has covered.

        Rows may still arrive with the very value of the mark. Give what is
        ``loaded`` and its ``keys``: the mark's value is then read again, less the
        keys that are there. Rows without a value have no place in the order;
        ``undated`` has them for quarantine.
        """
        text = self.value()
        if text is None:
            return df.where(F.col(column).isNotNull()) if loaded is not None else df
        mark = F.lit(text).cast(df.schema[column].dataType)
        if loaded is None:
            return since(df, column, mark)
        there = loaded.where(F.col(column) == mark).select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
        same = F.col(column) == mark
        for i, key in enumerate(keys):
            same = same & F.col(key).eqNullSafe(F.col(f"_key{i}"))
        return df.where(F.col(column) >= mark).join(there, same, "left_anti")

    def commit(self, batch: DataFrame, column: str) -> str | None:
        """Record the newest value of ``batch``; call it after the batch is safely written."""
        newest = batch.agg(F.max(column).cast("string").alias("m")).first()["m"]
        if newest is None:
            return self.value()
        runs = self._runs()
        paths.write_once(self.spark, f"{self.path}/{runs[-1] + 1 if runs else 0}.txt", newest)
        return newest
