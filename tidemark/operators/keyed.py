"""Per-key aggregates joined back to their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import settled, small_side


def with_group_values(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Add aggregates of each key's rows to every row of the key.

    An aggregate plus a join instead of a window: the aggregate combines before
    the shuffle, so a hot key costs no more than others, and rows are not
    shuffled at all when the groups are few enough to broadcast. NULL is a key
    like any other. Without keys, all rows are one group.
    """
    keys = list(keys)
    if not keys:
        whole = df.agg(F.struct(*[a.alias(name) for name, a in aggregates.items()])).scalar()
        return df.withColumn("_whole", whole).select(*df.columns, *[f"_whole.{name}" for name in aggregates])
    stats = df.groupBy(*keys).agg(*[a.alias(name) for name, a in aggregates.items()])
    return join_groups(df, settled(stats, "group-values"), keys)


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``groups``, which has one row per key, to the rows of ``df``."""
    right = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(right[f"_g_{k}"])
    return df.join(small_side(right), same, "left").drop(*[f"_g_{k}" for k in keys])
