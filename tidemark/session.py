"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable only, so they also apply to a session someone else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the join feeds an operator on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions of one key are merged before the shuffle, not only after it.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "tidemark") -> SparkSession:
    return tune(SparkSession.builder.appName(app).config("spark.ui.enabled", "false").getOrCreate())


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator expects.

    Shuffle parallelism belongs to the cluster, so it is only set in local mode,
    where the default of 200 is far too many tasks for a handful of cores. A
    cluster keeps streaming state in RocksDB, off the executor heap.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    if is_local(spark):
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    else:
        spark.conf.set(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    return spark


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
MOST_SHUFFLE_PARTITIONS = 100_000


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions that keep a partition of the whole input near 256 MB."""
    by_size = -(-input_bytes // SHUFFLE_PARTITION_BYTES)
    return max(cores, min(MOST_SHUFFLE_PARTITIONS, by_size))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles of a large job start with enough partitions; AQE merges small ones.

    The default of 200 would put 500 GB into each partition of a 100 TB shuffle,
    and AQE cannot split the partitions of an aggregation or a window.
    """
    count = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(count))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's ``spark.checkpoint.dir``.

    Only local mode may fall back to a temporary folder; on a cluster a path on
    one machine would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_FOLDERS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def together(*jobs: Callable[[], object]) -> None:
    """Run independent Spark jobs at the same time; the first error is raised after all have ended.

    Small writes leave most of a cluster idle when they run one after the other.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        started = [pool.submit(job) for job in jobs]
    for job in started:
        job.result()


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
