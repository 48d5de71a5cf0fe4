"""Helpers shared by the operators: scans in Arrow batches, stored intermediate tables, hashing."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import RUNTIME_SETTINGS, scratch
from tidemark.sinks.paths import total_bytes

ROOT = str(Path(__file__).resolve().parent.parent.parent)

# What separates words: the six white space characters of ASCII, as bytes.split() takes them.
WORD = r"[^\x20\x09-\x0D]+"

# Rows and bytes of an Arrow batch: a Python worker holds a few of these at a time.
BATCH_ROWS = 2000
BATCH_BYTES = 8 * 1024 * 1024
# Workers give freed blocks back to the machine at once instead of keeping them for later.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1024 * 1024)}
# Bytes of input that one shuffle partition may stand for.
SHUFFLE_BYTES = 128 * 1024 * 1024

SPARK_TO_ARROW = {
    T.LongType: pa.int64(),
    T.IntegerType: pa.int32(),
    T.DoubleType: pa.float64(),
    T.FloatType: pa.float32(),
    T.BooleanType: pa.bool_(),
    T.StringType: pa.string(),
    T.BinaryType: pa.binary(),
}


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return SPARK_TO_ARROW[type(kind)]


def prepare(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Session settings that the operators rely on; raises the shuffle partitions for a large input."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    spark.sparkContext.environment.update(WORKER_MEMORY)
    # Python workers import this package: from here, where the path is shared, else as installed there
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if folder is not None:
        wanted = -(-total_bytes(spark, folder) // SHUFFLE_BYTES)
        if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def local_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A DataFrame of a few rows that the driver holds, by way of Arrow: no Python worker has to unpack them."""
    fields = schema_of(ddl).fields
    columns = [pa.array([row[i] for row in rows], type=arrow_type(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=[f.name for f in fields]), schema_of(ddl))


def scan(df: DataFrame, ddl: str, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """Apply ``function`` to the Arrow batches of each partition; it yields dicts of columns."""
    schema = schema_of(ddl)
    arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)
            columns = None  # not to be held while the next batch is worked on
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give memory that a task has freed back to the machine: Spark keeps the worker, and others need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A copy of ``df`` in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy._stored_at = path
    return copy


def discard(*frames: DataFrame) -> None:
    """Remove stored copies that nothing will read again."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def crc_mod(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; NULL for a NULL key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


def n_words(text: Column) -> Column:
    """Number of words as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bounded(df: DataFrame, key: Column, rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows, chosen by a hash of the key; all rows if there are no more."""
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(int(1_000_000 * rows / total) + 1))


# A random 64-bit value for each byte, and an odd base: prefix sums of these give hashes of any slice.
_RANDOM = np.random.default_rng(0x5EED)
BYTE_VALUE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
# A second value, of the byte before as well, makes a second hash that fails apart from the first.
OTHER_VALUE = _RANDOM.integers(0, 2**64, 65536, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


class Powers:
    """Powers of the base and of its inverse, modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] a hash of raw[i:j], still times BASE**i."""
    up, _ = POWERS.upto(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * up[: len(raw)], out=prefix[1:])
    return prefix


def prefix_hashes_of_pairs(raw: np.ndarray) -> np.ndarray:
    """As ``prefix_hashes``, over neighbouring bytes: P[j] - P[i + 1] belongs to raw[i:j]."""
    up, _ = POWERS.upto(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    if len(raw) > 1:
        pairs = raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]
        np.cumsum(OTHER_VALUE[pairs] * up[1 : len(raw)], out=prefix[2:])
    return prefix


def slice_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each slice start:end; equal bytes have equal hashes wherever they stand."""
    _, down = POWERS.upto(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])
