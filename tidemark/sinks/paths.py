"""Small file-system helpers on Hadoop URIs, so any storage Spark can reach works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _open(spark, uri)
    return fs.exists(path)


def children(spark: SparkSession, uri: str) -> list[str]:
    """Names directly below ``uri``; empty when it does not exist."""
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def empty_files(spark: SparkSession, uri: str) -> list[str]:
    """Data files without a byte anywhere below ``uri``; markers and hidden files do not count."""
    fs, path = _open(spark, uri)
    found, every = [], fs.listFiles(path, True)
    while every.hasNext():
        status = every.next()
        if status.getLen() == 0 and status.getPath().getName()[0] not in "_.":
            found.append(status.getPath().toUri().toString())
    return found


def holds_data(spark: SparkSession, uri: str) -> bool:
    """Whether any data file lies below ``uri``; markers and hidden files do not count."""
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return False
    every = fs.listFiles(path, True)
    while every.hasNext():
        if every.next().getPath().getName()[0] not in "_.":
            return True
    return False


def delete(spark: SparkSession, uri: str) -> None:
    fs, path = _open(spark, uri)
    fs.delete(path, True)


def rename(spark: SparkSession, uri: str, to: str) -> None:
    """Move a file or folder; the parent of ``to`` is made."""
    fs, path = _open(spark, uri)
    _, target = _open(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(path, target):
        raise OSError(f"cannot move {uri} to {to}")


def write_once(spark: SparkSession, uri: str, text: str) -> None:
    """Create a small text file; fails if another writer already made it."""
    fs, path = _open(spark, uri)
    stream = fs.create(path, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_small(spark: SparkSession, uri: str) -> str:
    """Whole content of a small metadata file."""
    fs, path = _open(spark, uri)
    stream = fs.open(path)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def total_bytes(spark: SparkSession, uri: str) -> int:
    """Bytes of all files below ``uri``, from the file system's own summary."""
    fs, path = _open(spark, uri)
    return fs.getContentSummary(path).getLength()


def put(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small text file beside ``uri`` and rename it there, so nobody reads half of it.

    Replaces what is there where the file system can do that in one step, as HDFS
    and local disks do; object stores show a file only once it is complete.
    """
    jvm = spark.sparkContext._jvm
    draft = f"{uri}.{uuid.uuid4().hex[:12]}"
    write_once(spark, draft, text)
    _, target = _open(spark, uri)
    _, source = _open(spark, draft)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(source, target, how)


# Bytes in which the first line of a file must end.
FIRST_LINE_BYTES = 1024 * 1024


def first_line(spark: SparkSession, uri: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a text file, packed or not; reads one buffer at a time up to its end. None if there is none."""
    jvm = spark.sparkContext._jvm
    fs, path = _open(spark, uri)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(path)
    stream = fs.open(path)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(plain, FIRST_LINE_BYTES)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(bounded, encoding)).readLine()
    finally:
        stream.close()
