"""The schema an ingest has seen so far, as numbered files of ``StructType`` JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import schema_findings
from tidemark.sinks import paths

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"
RESERVED = (CORRUPT, RESCUED)


def widest(kind: T.DataType) -> T.DataType:
    """The type to log for an inferred one."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(widest(kind.elementType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, widest(f.dataType), True) for f in kind.fields])
    return kind


# Digits that a whole number of each type may have.
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
MOST_DIGITS = 38


def promote(known: T.DataType, seen: T.DataType, or_text: bool = False) -> T.DataType:
    """The least type that holds the values of both: whole numbers, decimals, doubles; dates, times.

    Types that have no such type in common stay as ``known``, whose misfits are then
    rescued or malformed, or become text with ``or_text``.
    """
    if known == seen or isinstance(seen, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return seen
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        return merge(known, seen, or_text)
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(promote(known.elementType, seen.elementType, or_text), True)
    if isinstance(known, T.NumericType) and isinstance(seen, T.NumericType):
        return _number(known, seen)
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(known, times) and isinstance(seen, times):
        return max(known, seen, key=lambda kind: times.index(type(kind)))
    return T.StringType() if or_text else known


def _number(known: T.DataType, seen: T.DataType) -> T.DataType:
    if any(isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) for kind in (known, seen)):
        return T.DoubleType()
    if not any(isinstance(kind, T.DecimalType) for kind in (known, seen)):
        return max(known, seen, key=lambda kind: WHOLE_DIGITS[type(kind)])
    sizes = [(k.precision, k.scale) if isinstance(k, T.DecimalType) else (WHOLE_DIGITS[type(k)], 0) for k in (known, seen)]
    scale = max(s for _, s in sizes)
    digits = max(p - s for p, s in sizes) + scale
    return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else T.DoubleType()


def merge(known: T.StructType, seen: T.StructType, or_text: bool = False) -> T.StructType:
    """``known`` with types promoted by ``seen``, plus the fields only ``seen`` has, also inside structs."""
    fresh = {f.name: f for f in seen.fields}
    fields = []
    for field in known.fields:
        other = fresh.pop(field.name, None)
        kind = field.dataType if other is None else promote(field.dataType, other.dataType, or_text)
        fields.append(T.StructField(field.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in seen.fields if f.name in fresh]
    return T.StructType(fields)


def holds(to: T.DataType, kind: T.DataType) -> bool:
    """Whether every value of ``kind`` has its place in ``to``."""
    if kind == to:
        return True
    if isinstance(to, T.StructType) and isinstance(kind, T.StructType):
        return all(f.name in to.names and holds(to[f.name].dataType, f.dataType) for f in kind.fields)
    if isinstance(to, T.ArrayType) and isinstance(kind, T.ArrayType):
        return holds(to.elementType, kind.elementType)
    if isinstance(to, T.StringType):
        return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return promote(to, kind) == to and promote(kind, to) == to


def retyped(before: T.StructType, after: T.StructType) -> bool:
    """Whether a column that both have has another type, inside a struct too; fields added to a struct do not count."""

    def differs(old: T.DataType, new: T.DataType) -> bool:
        if isinstance(old, T.StructType) and isinstance(new, T.StructType):
            return retyped(old, new)
        if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
            return differs(old.elementType, new.elementType)
        return old != new

    return any(f.name in after.names and differs(f.dataType, after[f.name].dataType) for f in before.fields)


def raised(kind: T.DataType, to: T.DataType, value: Column) -> Column:
    """``value`` of an older type as the type it was promoted to; struct fields go by name."""
    if isinstance(to, T.StructType):
        named = [
            (raised(kind[f.name].dataType, f.dataType, value[f.name]) if f.name in kind.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in to.fields
        ]
        return F.when(value.isNotNull(), F.struct(*named))
    if isinstance(to, T.ArrayType) and kind != to:
        return F.transform(value, lambda x: raised(kind.elementType, to.elementType, x))
    return value.try_cast(to)


def raise_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of an older version of ``schema`` in its columns and types; columns they lack are NULL."""
    have = df.schema
    return df.select(
        *[
            (raised(have[f.name].dataType, f.dataType, F.col(f"`{f.name}`")) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


class SchemaLog:
    """Versions of one schema; a version is written once and never changed."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def versions(self) -> list[int]:
        names = paths.children(self.spark, self.location)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(paths.read_small(self.spark, f"{self.location}/{number}.json")))

    def latest(self) -> T.StructType | None:
        present = self.versions()
        return self.version(present[-1]) if present else None

    def evolve(self, seen: T.StructType, widen: bool = True, reserved: bool = False, since: int | None = None) -> T.StructType:
        """Merge what was seen into the log and return the schema to read with.

        The columns for rescued and corrupt data are no part of the files'
        schema; ``reserved`` keeps them, for a log of a target. ``since`` is the number
        of the first batch that is written with the types of a new version.
        """
        usable = T.StructType([f for f in seen.fields if reserved or f.name not in RESERVED])
        if widen:
            usable = widest(usable)
        known = self.latest()
        merged = merge(known or T.StructType(), usable)
        if known != merged:
            present = self.versions()
            number = present[-1] + 1 if present else 0
            if since is not None and known is not None and retyped(known, merged):
                paths.put(self.spark, f"{self.location}/{number}.since", str(since))
            paths.write_once(self.spark, f"{self.location}/{number}.json", merged.json())
        return merged

    def epochs(self) -> list[tuple[int, T.StructType]]:
        """(first batch, last schema) of each run of versions between which no column changed its type."""
        out: list[tuple[int, T.StructType]] = []
        for number in self.versions():
            schema, mark = self.version(number), f"{self.location}/{number}.since"
            if out and paths.exists(self.spark, mark):
                out.append((int(paths.read_small(self.spark, mark)), schema))
            else:
                out = [*out[:-1], (out[-1][0] if out else 0, schema)]
        return out

    def history(self) -> DataFrame:
        """One row per change between consecutive versions."""
        rows = []
        before = T.StructType()
        for number in self.versions():
            after = self.version(number)
            for name, what, old, new in schema_findings(after, before):
                change = {"extra": "added", "missing": "removed", "mistyped": "retyped"}[what]
                rows.append((number, name, change, old, new))
            before = after
        return self.spark.createDataFrame(
            rows, "version int, column_name string, change string, old_type string, new_type string"
        )
