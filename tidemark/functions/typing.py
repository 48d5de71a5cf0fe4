"""Conversion of text columns to their real types, with error codes for misfits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import parse_first


# Shapes of text that may be a number; nothing else is worth an attempt.
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE_KINDS = ("tinyint", "smallint", "int", "bigint")
NUMBER_KINDS = ("float", "double", "decimal")


def convert(value: Column, kind: str, formats: Sequence[str] = ()) -> Column:
    """Text ``value`` as ``kind``, NULL where it does not fit.

    A failed conversion to a number raises and drops an exception per value,
    which is many times slower than looking at the text first.
    """
    if formats and kind in ("timestamp", "date"):
        return parse_first(value, formats).cast(kind)
    if kind in WHOLE_KINDS:
        return F.when(value.rlike(WHOLE), value.try_cast(kind))
    if kind.startswith(NUMBER_KINDS):
        return F.when(value.rlike(NUMBER), value.try_cast(kind))
    return value.try_cast(kind)


def misfit(value: Column, converted: Column) -> Column:
    return value.isNotNull() & converted.isNull()


def standardise(
    df: DataFrame,
    types: Mapping[str, str],
    formats: Mapping[str, Sequence[str]] | None = None,
    errors: str = "_errors",
) -> DataFrame:
    """Convert the named columns; each misfit adds ``bad_type:<column>`` to ``errors``."""
    formats = formats or {}
    fresh = {f"_new_{c}": convert(F.col(c), kind, formats.get(c, ())) for c, kind in types.items()}
    # in a step of its own, so that each value is converted once
    converted = df.withColumns(fresh)
    codes = [F.when(misfit(F.col(c), F.col(f"_new_{c}")), F.lit(f"bad_type:{c}")) for c in types]
    return converted.select(
        *[F.col(f"_new_{c}").alias(c) if c in types else F.col(c) for c in df.columns],
        F.array_compact(F.array(*codes)).alias(errors),
    )
