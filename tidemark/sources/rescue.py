"""Typed reading that keeps whatever does not fit the schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.typing import convert
from tidemark.sources.schema_log import CORRUPT, RESCUED


def _rescued_json(kept: Column) -> Column:
    return F.when(F.size(kept) > 0, F.to_json(kept))


def rescue_json(text: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON lines to the columns of ``schema`` plus two for the rest.

    ``_rescued_data`` holds, as JSON, fields the schema does not know and values
    that do not fit their type, NULL if there are none. ``_corrupt_record`` holds
    the whole text of a line that is not a JSON object. Blank lines vanish.
    """
    line = F.col(value)
    lines = text.where(F.length(F.trim(line)) > 0)
    is_object = F.json_object_keys(line).isNotNull()
    raw = F.when(is_object, F.from_json(line, "map<string,string>"))
    parsed = lines.select(
        F.when(is_object, F.from_json(line, schema)).alias("_typed"),
        raw.alias("_raw"),
        F.when(~is_object, line).alias(CORRUPT),
    )
    misfits = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("_typed").getField(f.name).isNull() & F.col("_raw").getItem(f.name).isNotNull(), F.lit(f.name)
                )
                for f in schema.fields
            ]
        )
    )
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    parsed = parsed.withColumn("_misfits", misfits)
    kept = F.map_filter(
        "_raw", lambda k, v: v.isNotNull() & (~F.array_contains(known, k) | F.array_contains(F.col("_misfits"), k))
    )
    return parsed.select(
        *[F.col("_typed").getField(f.name).alias(f.name) for f in schema.fields],
        _rescued_json(kept).alias(RESCUED),
        CORRUPT,
    )


def rescue_strings(df: DataFrame, schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """All-text columns to the types of ``schema``; the rest goes to ``_rescued_data``."""
    have = [c for c in df.columns if c not in carry]
    known = [f for f in schema.fields if f.name in have]
    fresh = {f"_new_{f.name}": convert(F.col(f"`{f.name}`"), f.dataType.simpleString()) for f in known}
    # in a step of its own, so that each value is converted once
    converted = df.withColumns(fresh)
    typed = [
        (F.col(f"`_new_{f.name}`") if f in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
    ]
    kept = []
    for name in have:
        raw = F.col(f"`{name}`")
        lost = F.when(F.col(f"`_new_{name}`").isNull(), raw) if name in schema.names else raw
        kept += [F.lit(name), lost]
    everything = F.map_filter(F.create_map(*kept), lambda _, v: v.isNotNull())
    return converted.select(*typed, _rescued_json(everything).alias(RESCUED), *carry)


def rescue_corrupt(df: DataFrame, fields: Column, schema: T.StructType) -> DataFrame:
    """Add ``_rescued_data`` to typed rows: what a row with a corrupt record holds that its columns do not.

    ``fields`` are the fields of the record as a map of text, NULL where it has none.
    """
    unread = [F.when(F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields]
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    lost = F.map_filter(
        fields, lambda k, v: v.isNotNull() & (~F.array_contains(known, k) | F.array_contains(F.array_compact(F.array(*unread)), k))
    )
    return df.withColumn(RESCUED, F.when(F.col(CORRUPT).isNotNull(), _rescued_json(lost)))
