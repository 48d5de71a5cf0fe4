"""Star joins, enrichment, and point-in-time lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequences import KeySequence
from tidemark.operators.sizing import small_side


@dataclass(frozen=True)
class Dimension:
    """A dimension table, the fact column that refers to it, and its own key."""

    table: DataFrame
    fact_key: str
    key: str
    how: str = "left"


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Join a fact to its dimensions one after the other.

    Dimensions that are known to be small are broadcast, so the fact is not
    shuffled for them; others join by shuffle with adaptive skew splitting.
    """
    joined = fact
    for d in dimensions:
        joined = joined.join(small_side(d.table), joined[d.fact_key] == d.table[d.key], d.how)
        joined = joined.drop(d.table[d.key])
    return joined


def enrich(
    df: DataFrame, reference: DataFrame, on: Mapping[str, str], add: Sequence[str], unknown: str = "UNKNOWN"
) -> DataFrame:
    """Add reference columns by key (``df`` column -> reference column); misses get ``unknown``."""
    right = reference.select(
        *[F.col(r).alias(f"_k_{r}") for r in on.values()], *[F.col(c).alias(f"_v_{c}") for c in add]
    )
    same = F.lit(True)
    for left_name, right_name in on.items():
        same = same & (df[left_name] == right[f"_k_{right_name}"])
    joined = df.join(small_side(right), same, "left")
    return joined.select(
        *[df[c] for c in df.columns], *[F.coalesce(f"_v_{c}", F.lit(unknown)).alias(c) for c in add]
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but missing in the parent."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    present = child.where(F.col(child_key).isNotNull())
    return present.join(small_side(keys), present[child_key] == keys["_parent"], "left_anti")


def point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    add: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    **slicing,
) -> DataFrame:
    """Add the columns of the version that was valid at each fact's time.

    A version holds in ``[valid_from, valid_to)``; an open end is NULL. Facts and
    versions are merged into one sequence per key and the newest version is
    carried forward, so no fact is ever paired with all versions of its key.
    """
    version = F.struct(F.col(valid_to).alias("_to"), *[F.col(c) for c in add])
    left = facts.select(*facts.columns, F.col(at).alias("_at"), F.lit(1).alias("_side"))
    # a version that never begins holds at no time
    right = versions.where(F.col(valid_from).isNotNull()).select(
        key, F.col(valid_from).alias("_at"), F.lit(0).alias("_side"), version.alias("_version")
    )
    rows = left.unionByName(right, allowMissingColumns=True)
    carried = KeySequence(rows, [key], ["_at", "_side"], **slicing).add(last_known={"_valid": "_version"})
    holds = F.col("_valid._to").isNull() | (F.col("_at") < F.col("_valid._to"))
    found = carried.where((F.col("_side") == 1))
    known = F.col(key).isNotNull() & F.col("_at").isNotNull() & holds
    return found.select(*facts.columns, *[F.when(known, F.col(f"_valid.{c}")).alias(c) for c in add])
