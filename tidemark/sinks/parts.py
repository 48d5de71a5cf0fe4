"""Tables in hash parts, with a manifest per version: a merge rewrites only the parts it touches."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import schema_findings
from tidemark.operators.sizing import estimated_bytes
from tidemark.sinks import paths
from tidemark.sinks.batch import CODEC, SchemaMismatch

PART_BYTES = 256 * 1024 * 1024
# A table is dealt out anew, into more parts, once they have grown to so many times their size.
TOO_LARGE = 4
# Where a row that was placed belongs, and slices of parts for each task of a shuffle: few leave tasks uneven.
PLACE = ("_part", "_slice")
SLICES = 4


@dataclass(frozen=True)
class Manifest:
    """What a version consists of: the folder of each part that has rows, and notes of its writer."""

    version: int
    parts: int
    schema: T.StructType
    folders: Mapping[int, str]
    notes: Mapping[str, object]


class PartTable:
    """A path holding parts by key hash, and numbered manifests that name the folder of each part.

    A new version writes the parts it changes and links the others, so its cost follows
    the parts of its keys, not the table. It counts once its manifest is there, which is
    put in place by a rename; writing a number again (a replayed micro-batch) starts
    from the version before it and replaces it. There must be one writer at a time.

    Manifests have an entry per part and pass through the driver: 400,000 entries
    for 100 TB in parts of 256 MB.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], parts: int | None = None, keep: int = 3,
        part_bytes: int = PART_BYTES,
    ):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.parts, self.keep, self.part_bytes = parts, keep, part_bytes

    def versions(self) -> list[int]:
        found = paths.children(self.spark, f"{self.path}/manifests")
        return sorted(int(name[2:-5]) for name in found if name.startswith("v=") and name.endswith(".json"))

    def manifest(self, version: int | None = None, before: int | None = None) -> Manifest | None:
        """The manifest of a version; the newest one, or the newest below ``before``, if none is given."""
        usable = [v for v in self.versions() if (version is None or v == version) and (before is None or v < before)]
        if not usable:
            return None
        told = json.loads(paths.read_small(self.spark, self._file(usable[-1])))
        folders = {int(part): folder for part, folder in told["folders"].items()}
        return Manifest(usable[-1], told["parts"], T.StructType.fromJson(told["schema"]), folders, told["notes"])

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame | None:
        """A version, the newest one if none is given, or ``only`` some of its parts; None without a version."""
        manifest = self.manifest(version)
        return None if manifest is None else self._read(manifest, only)

    def part(self, parts: int) -> Column:
        """Number of the part that a row belongs to."""
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(parts)).cast("int")

    def touched(self, rows: DataFrame, parts: int) -> list[int]:
        """Parts that the keys of ``rows`` belong to: at most as many numbers as there are parts."""
        return sorted(r[0] for r in rows.select(self.part(parts)).distinct().collect())

    def place(self, df: DataFrame, parts: int) -> DataFrame:
        """``df`` dealt by part and slice of a part, in ``PLACE``: what groups by these and keys is stored as it lies.

        A slice is told by the keys too, so a task holds whole keys, and a part lies in few files.
        """
        slices = max(1, math.ceil(SLICES * _shuffle_tasks(self.spark) / parts))
        slice_ = F.floor(self.part(parts * slices) / F.lit(parts)).cast("int")  # the rest by parts is the part
        return df.withColumns({"_part": self.part(parts), "_slice": slice_}).repartition(*PLACE)

    def write(
        self, df: DataFrame, version: int | None = None, notes: Mapping | None = None,
        settle: Callable[[DataFrame], DataFrame] | None = None,
    ) -> Manifest:
        """A version that holds just the rows of ``df``, or of ``settle(df)`` with ``df`` placed."""
        version = self._next(version)
        parts = self.parts or max(8, math.ceil(estimated_bytes(df) / self.part_bytes))
        out = settle(self.place(df, parts)) if settle else df
        return self._commit(version, parts, out.drop(*PLACE).schema, self._store(out, version, parts), notes)

    def merge(
        self, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None,
        notes: Mapping | None = None, also: Sequence[int] = (),
        settle: Callable[[DataFrame], DataFrame] | None = None,
    ) -> Manifest:
        """The version before ``version`` with ``combine(rows, source)`` in the parts of the keys of ``source``.

        ``source`` is read twice and must not change between; parts named in
        ``also`` are rewritten too. Columns that are new appear as NULL in rows of other parts.
        With ``settle``, what was combined is placed, and ``settle`` of it is stored without another shuffle.
        """
        current = self.manifest(before=version)
        if current is None:
            return self.write(combine(None, source), version, notes, settle)
        version, parts = self._next(version), current.parts
        if self._bytes(current) > TOO_LARGE * parts * self.part_bytes:
            parts *= TOO_LARGE
        touched = set(self.touched(source, parts)) | set(also) if parts == current.parts else None
        merged = combine(self._read(current, touched), source)
        if settle:
            merged = settle(self.place(merged, parts))
        schema = merged.drop(*PLACE).schema
        clashing = [f for f in schema_findings(schema, current.schema) if f[1] != "extra"]
        if clashing:  # the linked parts are read with the new version's schema
            raise SchemaMismatch("; ".join(f"{name}: {what} ({want} to {got})" for name, what, want, got in clashing))
        folders = self._store(merged, version, parts)
        linked = {} if touched is None else {p: folder for p, folder in current.folders.items() if p not in touched}
        return self._commit(version, parts, schema, {**linked, **folders}, notes)

    def _next(self, version: int | None) -> int:
        if version is not None:
            return version
        present = self.versions()
        return present[-1] + 1 if present else 0

    def _file(self, version: int) -> str:
        return f"{self.path}/manifests/v={version}.json"

    def _read(self, manifest: Manifest, only: Sequence[int] | None = None) -> DataFrame:
        chosen = [f"{self.path}/{folder}" for part, folder in manifest.folders.items() if only is None or part in only]
        if not chosen:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*chosen)

    def _store(self, df: DataFrame, version: int, parts: int) -> dict[int, str]:
        folder = f"data/v={version}"
        if PLACE[0] in df.columns:
            placed = df.drop(PLACE[1])
        else:
            placed = df.withColumn("_part", self.part(parts)).hint("rebalance", F.col("_part"))
        placed.write.mode("overwrite").option("compression", CODEC).partitionBy("_part").parquet(f"{self.path}/{folder}")
        written = [name for name in paths.children(self.spark, f"{self.path}/{folder}") if name.startswith("_part=")]
        return {int(name[6:]): f"{folder}/{name}" for name in written}

    def bytes(self, version: int) -> int:
        """Bytes of the files that a version consists of."""
        return self._bytes(self.manifest(version))

    def _bytes(self, manifest: Manifest) -> int:
        return sum(paths.total_bytes(self.spark, f"{self.path}/{folder}") for folder in manifest.folders.values())

    def _commit(self, version: int, parts: int, schema: T.StructType, folders: Mapping, notes: Mapping | None) -> Manifest:
        told = {"parts": parts, "schema": schema.jsonValue(), "folders": folders, "notes": dict(notes or {})}
        paths.put(self.spark, self._file(version), json.dumps(told))
        self._forget(version)
        return Manifest(version, parts, schema, folders, told["notes"])

    def forget(self, version: int) -> None:
        """Delete all versions before ``version``, with the parts that only they hold."""
        self._forget(version, 0)

    def _forget(self, version: int, keep: int | None = None) -> None:
        """Delete manifests beyond ``keep`` before ``version``, and the part folders that no manifest links."""
        keep = self.keep if keep is None else keep
        old = [v for v in self.versions() if v < version]
        for gone in old[: len(old) - keep]:
            paths.delete(self.spark, self._file(gone))
        if len(old) <= keep:
            return
        linked = {folder for v in self.versions() for folder in self.manifest(v).folders.values()}
        for written in paths.children(self.spark, f"{self.path}/data"):
            if int(written[2:]) >= version:
                continue
            names = [n for n in paths.children(self.spark, f"{self.path}/data/{written}") if n.startswith("_part=")]
            free = [n for n in names if f"data/{written}/{n}" not in linked]
            if len(free) == len(names):
                paths.delete(self.spark, f"{self.path}/data/{written}")
            else:
                for name in free:
                    paths.delete(self.spark, f"{self.path}/data/{written}/{name}")


def _shuffle_tasks(spark: SparkSession) -> int:
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or spark.conf.get("spark.sql.shuffle.partitions"))


def upsert_rows(keys: Sequence[str]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """A combination for ``merge``: rows of the source replace those of equal key."""
    from tidemark.operators.change_data import upsert

    def combine(rows: DataFrame | None, source: DataFrame) -> DataFrame:
        return source if rows is None else upsert(rows, source, keys)

    return combine


class Pointer:
    """A small file that says which version of each table readers get; switched by a rename."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri

    def get(self) -> dict[str, int]:
        return json.loads(paths.read_small(self.spark, self.uri)) if paths.exists(self.spark, self.uri) else {}

    def set(self, versions: Mapping[str, int]) -> None:
        paths.put(self.spark, self.uri, json.dumps(dict(versions)))
