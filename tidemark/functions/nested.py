"""Flattening of nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(kind: T.DataType, value: Column, name: str, separator: str) -> list[Column]:
    if not isinstance(kind, T.StructType):
        return [value.alias(name)]
    out = []
    for field in kind.fields:
        out += _leaves(field.dataType, value.getField(field.name), f"{name}{separator}{field.name}", separator)
    return out


def flatten(df: DataFrame, separator: str = "_", explode_arrays: bool = False) -> DataFrame:
    """Turn struct fields into top-level columns named by their path.

    Arrays stay as they are unless ``explode_arrays``; then each element becomes
    a row (an empty or NULL array keeps its row with NULL) and structs inside are
    flattened in turn.
    """
    out = []
    for field in df.schema.fields:
        out += _leaves(field.dataType, F.col(f"`{field.name}`"), field.name, separator)
    flat = df.select(*out)
    if not explode_arrays:
        return flat
    arrays = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not arrays:
        return flat
    for name in arrays:
        flat = flat.withColumn(name, F.explode_outer(f"`{name}`"))
    return flatten(flat, separator, explode_arrays)
