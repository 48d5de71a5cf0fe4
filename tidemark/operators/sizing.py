"""Size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch

# of files or rows as estimated; the hash table of a broadcast is several times larger
BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; unknown inputs count as enormous.

    Costs no job, and is a rough figure only: file scans report the bytes of the
    files, which may be far below what they hold, and rows that a generator makes
    are not counted. Only a large answer means something; see ``known_small``.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


# Fixed-width rows from plain files below this size are taken as small without a look at them.
TRUSTED_BYTES = 1024 * 1024
# What a plan may consist of to be read again at the cost of its files.
_PLAIN = {"Project", "Filter", "Relation", "LocalRelation", "LogicalRDD", "SubqueryAlias"}
_NODE = re.compile(r"^[\s:+\-|]*(?:'|!)?([A-Z]\w*)", re.M)
# Bytes in memory of what has been measured: plans over files, and folders that were written here.
_MEASURED: dict[tuple, int] = {}


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of all rows as they are in memory, as an aggregate."""
    fixed, parts = 16, []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)))
        fixed += 16
    return F.coalesce(F.sum(sum(parts, F.lit(fixed)).cast("long")), F.lit(0).cast("long")).alias("n")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows as they are in memory, by one aggregation over them."""
    return df.agg(_row_bytes(df)).first()["n"]


def known_small(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` is known to fit ``limit``, without running more than a scan of small files.

    Above the limit by estimate nothing is measured. Files are measured once, since
    compressed text may be thousands of times larger in memory; copies that
    ``stored`` wrote were measured as they were written. A plan that computes anything is not run for this: it
    stays unknown, and AQE sees its size when the join runs.
    """
    if df.isStreaming:
        return False
    plan = df._jdf.queryExecution().optimizedPlan()
    if int(str(plan.stats().sizeInBytes())) > limit:
        return False
    if not set(_NODE.findall(plan.toString())) <= _PLAIN:
        return False
    written = _written_bytes(df)
    if written is not None:
        return written <= limit
    wide = any(not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in df.schema.fields)
    if not wide and int(str(plan.stats().sizeInBytes())) <= TRUSTED_BYTES:
        return True
    key = (df.semanticHash(), *sorted(df.inputFiles()))
    if len(key) == 1:  # rows of the session itself, which other rows may equal by hash
        return measured_bytes(df) <= limit
    if key not in _MEASURED:
        _MEASURED[key] = measured_bytes(df)
    return _MEASURED[key] <= limit


def known_few(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` is known to have no more than ``rows`` rows, by the least bytes that each row counts for."""
    return known_small(df, rows * 16 * (1 + len(df.columns)))


def _written_bytes(df: DataFrame) -> int | None:
    """Measured bytes of the copy that ``df`` reads columns and rows of; None if it reads anything else."""
    folders = {file.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for file in df.inputFiles()}
    if len(folders) != 1 or ("stored", *folders) not in _MEASURED:
        return None
    fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in df.schema.fields)
    return _MEASURED[("stored", *folders)] if fixed or _only_renames(df) else None


def _only_renames(df: DataFrame) -> bool:
    """Whether every column is one of the files' columns, perhaps by another name."""
    named = re.findall(r"^[\s:+\-|]*Project \[(.*)\]$", df._jdf.queryExecution().optimizedPlan().toString(), re.M)
    return all(re.fullmatch(r"[^()]+", items) for items in named)


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if it is known to be small, else leave the join to shuffle.

    Without the hint the join is still adaptive: AQE broadcasts a side that turns out
    small at run time, and splits hot keys of a sort-merge join.
    """
    return F.broadcast(df) if known_small(df, limit) else df


def settled(df: DataFrame, name: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, written to the shared folder first unless it is files that are known to be small.

    Meant for aggregates of large inputs: the optimizer can only over-estimate
    them, and once written, their true size decides how they are joined. They are
    computed once, and the copy survives the loss of executors.
    """
    if known_small(df, limit):
        return df
    return stored(df, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A copy of ``df`` in the shared folder, measured while it is written."""
    spark = df.sparkSession
    folder = scratch(spark, name)
    size = Observation()
    df.observe(size, _row_bytes(df)).write.parquet(folder)
    _MEASURED["stored", folder.split(":", 1)[-1].lstrip("/")] = size.get["n"]
    return spark.read.schema(df.schema).parquet(folder)
