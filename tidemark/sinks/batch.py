"""Batch writers: partitioned layouts, upserts by partition, retention, clustering, buckets."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.change_data import upsert
from tidemark.operators.quality import schema_findings
from tidemark.operators.sizing import estimated_bytes, measured_bytes, small_side, stored
from tidemark.sinks import paths


# Of tables that are kept: a fifth to a third smaller than Spark's default.
CODEC = "zstd"


class SchemaMismatch(ValueError):
    """A batch does not have the schema of its target."""


def enforce_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` itself, or an error that lists every missing, extra and mistyped column."""
    findings = schema_findings(df.schema, expected)
    if findings:
        raise SchemaMismatch(
            "; ".join(f"{name}: {what} (expected {want}, got {got})" for name, what, want, got in findings)
        )
    return df


def enforce_target(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df``, which must have the columns and types of the files at ``path``, if there are any.

    Partition columns are compared by name only: their types are read off the folder names.
    """
    spark = df.sparkSession
    if not any(name[0] not in "_." for name in paths.children(spark, path)):
        return df
    plain = lambda schema: T.StructType([f for f in schema.fields if f.name not in partition_by])
    there = spark.read.parquet(path).schema
    lost = [c for c in partition_by if c not in df.columns]
    if lost:
        raise SchemaMismatch("; ".join(f"{c}: missing" for c in lost))
    enforce_schema(df.select(*[F.col(f"`{f.name}`") for f in plain(df.schema).fields]), plain(there))
    return df


def append_enforced(df: DataFrame, path: str, merge_schema: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Append to a parquet path; a different schema is refused unless it may be merged."""
    if not merge_schema:
        enforce_target(df, path, partition_by)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (), replace_schema: bool = False
) -> None:
    """Replace the rows of a catalog table, external when a path is given; a new schema only if that is said."""
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(name):
        enforce_schema(df, spark.table(name).schema)
    writer = df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True, covers: Column | None = None,
    merge_schema: bool = False,
) -> None:
    """Write ``df`` over exactly the partitions it has rows for; others stay.

    ``covers`` is a condition on the partition columns that says what ``df`` is
    all of: partitions there that got no rows are removed. With it, repeating a
    write gives the same table even if rows are gone since, which makes replays
    and backfills safe.
    Rebalancing gathers the rows of each partition so that few files are written,
    and AQE splits a partition that is too large for one task. Rows of another
    schema than the table's are refused unless ``merge_schema``.
    """
    if not merge_schema:
        enforce_target(df, path, partition_by)
    spark = df.sparkSession
    before = _files(spark, path, covers) if covers is not None else {}
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    if before:
        # a partition that got rows has new files only; one that still has old ones got none
        after = _files(spark, path, covers)
        for folder in {f.rsplit("/", 1)[0] for f in after if f in before}:
            paths.delete(spark, folder)


def _files(spark: SparkSession, path: str, covers: Column) -> set[str]:
    """Names of the files in the partitions that ``covers`` holds for; none is opened."""
    if not any("=" in name and name[0] not in "_." for name in paths.children(spark, path)):
        return set()
    every = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return {r.path for r in every.where(covers).select("path").collect()}


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: str) -> None:
    """Upsert by key into a partitioned table, rewriting only partitions that ``source`` touches.

    The partition column must be a function of the key, so that a row never moves
    between partitions. Partitions that are not touched are neither read nor
    written. The values that are collected number at most the partitions.
    """
    touched = [row[0] for row in source.select(partition_by).distinct().collect()]
    target = spark.read.parquet(path)
    column = F.col(partition_by)
    affected = target.where(column.isin([v for v in touched if v is not None]) | (F.lit(None in touched) & column.isNull()))
    replace_partitions(upsert(affected, source, keys), path, [partition_by])


def merge_into(source: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports MERGE, such as Delta or Iceberg.

    Plain parquet does not; use ``merge_partitions`` or a ``SnapshotTable`` there.
    """
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"{name}.{key}") == F.col(f"source.{key}"))
    source.alias("source").mergeInto(name, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def analyze(spark: SparkSession, name: str) -> None:
    """Collect row count and column statistics of a catalog table for the optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def land(df: DataFrame, path: str, load_date: str, source_system: str) -> None:
    """Land raw rows by load date and source, in whatever schema they have; landing the same day again replaces it."""
    stamped = df.withColumns({"load_date": F.lit(load_date), "source_system": F.lit(source_system)})
    covers = (F.col("load_date").cast("string") == load_date) & (F.col("source_system") == source_system)
    replace_partitions(stamped, path, ["load_date", "source_system"], rebalance=False, covers=covers, merge_schema=True)


def by_month(df: DataFrame, day: str) -> DataFrame:
    """Add the ``year`` and ``month`` columns that gold tables are partitioned by."""
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def expire(spark: SparkSession, path: str, column: str, as_of: str, days: int) -> list[str]:
    """Drop date partitions older than ``days`` before ``as_of``; returns what was dropped.

    Whole directories go, no data is read or rewritten. Only the names of the
    partitions pass through the driver.
    """
    cutoff = (dt.date.fromisoformat(as_of) - dt.timedelta(days=days)).isoformat()
    prefix = f"{column}="
    dropped = []
    for name in paths.children(spark, path):
        if name.startswith(prefix) and name[len(prefix) :] < cutoff:
            paths.delete(spark, f"{path}/{name}")
            dropped.append(name[len(prefix) :])
    return dropped


# --- file layout ---------------------------------------------------------------


# Rows, by their size in memory, that one task sorts; files may hold many times that when they compress well.
SORT_BYTES = 512 * 1024 * 1024


def sort_tasks(df: DataFrame, least: int = 1) -> int:
    """Tasks among which ``df`` is dealt so that each sorts ``SORT_BYTES`` at most, by one measuring pass."""
    return max(least, math.ceil(measured_bytes(df) / SORT_BYTES))


Z_BITS = 10
# Rows sampled for the boundaries of a column's cells, and characters of text that these keep.
Z_SAMPLE = 65_536
Z_TEXT = 64


def _rankable(df: DataFrame, column: str) -> Column:
    """The column in a type whose boundaries can stand in an expression; keeps its order."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.hex(F.substring(value.cast("binary"), 1, Z_TEXT))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return value.cast("double")
    return value.cast("bigint")


def cell_bounds(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> dict[str, list]:
    """For each column at most 2**bits - 1 values that end equal counts of its rows.

    They come from one sample of about ``Z_SAMPLE`` rows, so an outlier is one row
    among many and text that begins alike is told apart further on. NULL is below all.
    """
    rows = df.count()
    chosen = df.where(F.rand(11) < Z_SAMPLE / rows) if rows > Z_SAMPLE else df
    sorts = [F.sort_array(F.collect_list(_rankable(df, c))).alias(f"s{i}") for i, c in enumerate(columns)]
    found = chosen.agg(*sorts).first()
    cells = 1 << bits
    out = {}
    for c, sample in zip(columns, found, strict=True):
        values = [v for v in sample if v == v]  # no NaN, which is above all bounds
        out[c] = sorted({values[len(values) * i // cells] for i in range(1, cells)} - {values[-1]}) if values else []
    return out


def z_value(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> Column:
    """Interleaved bits of the columns' ranks: rows close in all columns get close values."""
    bounds = cell_bounds(df, columns, bits)
    z = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        if not bounds[c]:
            continue
        value, points = _rankable(df, c), bounds[c]
        # the bounds in blocks: first the block, then the place in it
        width = math.isqrt(len(points)) + 1
        blocks = [points[at : at + width] for at in range(0, len(points), width)]
        ends, inside = F.lit([block[-1] for block in blocks]), F.array(*[F.lit(block) for block in blocks])
        block = F.size(F.filter(ends, lambda p: p < value))  # noqa: B023
        place = F.size(F.filter(F.coalesce(F.get(inside, block), F.lit(points[:0]).cast(f"array<{_element(points)}>")), lambda p: p < value))  # noqa: B023
        # past the last bound, which may end a shorter block
        rank = F.when(value.isNull(), 0).otherwise(F.least(block * F.lit(width) + place, F.lit(len(points)))).cast("bigint")
        # few values use the high bits too, so that no column decides alone
        cell = F.floor(rank * F.lit(1 << bits) / F.lit(len(points) + 1)).cast("bigint")
        for bit in range(bits):
            picked = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(picked, bit * len(columns) + i))
    return z


def _element(points: list) -> str:
    return "string" if isinstance(points[0], str) else "double" if isinstance(points[0], float) else "bigint"


def clustered(
    df: DataFrame, columns: Sequence[str], files: int, z_order: bool = False, within: Sequence[str] = ()
) -> DataFrame:
    """Rows range-partitioned and sorted by ``columns``, or along a Z-curve through them, inside ``within``.

    A digest of the whole row comes last in the range, so a value that fills a
    third of the table is still split over many files.
    """
    spread = F.xxhash64(*df.columns)
    if z_order:  # one more reading for the count and one for the sample
        keyed = df.withColumn("_z", z_value(df, columns))
        return keyed.repartitionByRange(files, *within, "_z", spread).sortWithinPartitions(*within, "_z").drop("_z")
    return df.repartitionByRange(files, *within, *columns, spread).sortWithinPartitions(*within, *columns)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition columns of a table folder, from its directories."""
    found = []
    while below := [name for name in paths.children(spark, path) if "=" in name and name[0] not in "_."]:
        found.append(below[0].split("=", 1)[0])
        path = f"{path}/{below[0]}"
    return found


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    file_bytes: int = 512 * 1024 * 1024,
    z_order: bool = False,
) -> None:
    """Rewrite small files as few large ones, clustered for the common filters; partitions stay as they are.

    A file has ``file_bytes`` at most, and no more rows than its task can sort in memory.
    """
    df = spark.read.parquet(source)
    parts = partition_columns(spark, source)
    files = sort_tasks(df, math.ceil(estimated_bytes(df) / file_bytes) or 1)
    rows = clustered(df, columns, files, z_order, parts)
    rows.write.mode("overwrite").partitionBy(*parts).parquet(target)


def bucket_count(df: DataFrame, bucket_bytes: int = 512 * 1024 * 1024, least: int = 8) -> int:
    return max(least, math.ceil(estimated_bytes(df) / bucket_bytes))


def write_bucketed_pair(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    names: tuple[str, str],
    locations: tuple[str, str],
    buckets: int | None = None,
    hot_rows: int = 20_000_000,
) -> None:
    """Bucket a fact and the table it joins to by key, so the join needs no shuffle.

    A key with more than ``hot_rows`` rows in ``left`` would fill one bucket. Its
    rows get as many salts as keep each near ``hot_rows``, by a digest of the row,
    and the ``right`` rows of that key are repeated once per salt. All other keys
    have salt 0 and are stored once. Hot keys number at most rows / hot_rows.
    """
    buckets = buckets or bucket_count(left)
    most = "spark.sql.sources.bucketing.maxBuckets"
    left.sparkSession.conf.set(most, str(max(buckets, int(left.sparkSession.conf.get(most)))))
    hot = left.groupBy(F.col(left_key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot.where(F.col("_n") > hot_rows).select("_hot", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    hot = stored(hot, "hot-buckets")
    salt = F.pmod(F.xxhash64(*left.columns), F.col("_salts")).cast("int")
    salted = left.join(small_side(hot), F.col(left_key) == F.col("_hot"), "left")
    salted = salted.select(*left.columns, F.coalesce(salt, F.lit(0)).alias("_salt"))
    every = F.sequence(F.lit(0), F.col("_salts") - 1)
    repeated = right.join(small_side(hot), F.col(right_key) == F.col("_hot"), "left")
    repeated = repeated.select(*right.columns, F.explode(F.coalesce(every, F.array(F.lit(0)))).alias("_salt"))
    for df, key, name, location in (
        (salted, left_key, names[0], locations[0]),
        (repeated, right_key, names[1], locations[1]),
    ):
        # one task per bucket, so each bucket is one sorted file
        (
            df.repartition(buckets, key, "_salt")
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, key, "_salt")
            .sortBy(key, "_salt")
            .option("path", location)
            .saveAsTable(name)
        )


def join_bucketed(spark: SparkSession, names: tuple[str, str], left_key: str, right_key: str) -> DataFrame:
    """Inner join of a pair written by ``write_bucketed_pair``, without an exchange."""
    left, right = spark.table(names[0]), spark.table(names[1]).withColumnRenamed("_salt", "_right_salt")
    same = (left[left_key] == right[right_key]) & (left["_salt"] == right["_right_salt"])
    return left.hint("merge").join(right, same).drop("_salt", "_right_salt")


# --- formats -------------------------------------------------------------------


def export(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> None:
    """Write as parquet, orc, json or csv with a header.

    CSV tells NULL from empty text, and doubles quotes inside quoted text.
    """
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("nullValue", "\\N")
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    writer.format(fmt).save(path)
