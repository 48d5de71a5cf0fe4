"""Ranking, bucket, ratio and trend features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyed import with_group_values
from tidemark.operators.sequences import KeySequence, ascending


def bucket_by_edges(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open bucket ``[edge, next edge)``; needs one label more than edges."""
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must number one more than edges")
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        chain = chain.when(value < edge, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def ntile(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str, **slicing) -> DataFrame:
    """Split each key's rows into ``n`` buckets of nearly equal size, larger ones first."""
    sequence = KeySequence(df, keys, order, **slicing)
    if not sequence.sliced:
        w = Window.partitionBy(*keys).orderBy(*ascending(df, order))
        return df.withColumn(name, F.ntile(n).over(w).cast("bigint"))
    sized = with_group_values(sequence.add(row_number="_rn"), keys, _rows=F.count(F.lit(1)))
    base = F.floor(F.col("_rows") / n)
    extra = F.col("_rows") % n
    in_large = F.col("_rn") <= extra * (base + 1)
    large = F.ceil(F.col("_rn") / (base + 1))
    small = extra + F.ceil(F.try_divide(F.col("_rn") - extra * (base + 1), base))
    return sized.withColumn(name, F.when(in_large, large).otherwise(small).cast("bigint")).drop("_rn", "_rows")


def ratio_to_total(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Share of ``value`` in its key's total; NULL where the total is zero or NULL."""
    totals = with_group_values(df, keys, _total=F.sum(value))
    return totals.withColumn(
        name, F.try_divide(F.col(value).cast("double"), F.col("_total").cast("double"))
    ).drop("_total")


def growth_alert(
    df: DataFrame, keys: Sequence[str], period: str, volume: str, threshold: float = 0.10
) -> DataFrame:
    """Growth over the previous period of the key, flagged above ``threshold``.

    ``df`` holds one row per key and period, so no key has more rows than there
    are periods and a plain window will do.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    previous = df.withColumn("previous_volume", F.lag(volume).over(w))
    growth = F.try_divide(
        F.col(volume).cast("double") - F.col("previous_volume"), F.col("previous_volume").cast("double")
    )
    return previous.withColumn("growth", growth).withColumn(
        "is_alert", F.coalesce(F.col("growth") > threshold, F.lit(False))
    )


def duration_regression(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], duration: str, factor: float = 2.0, **slicing
) -> DataFrame:
    """Flag rows that took at least ``factor`` times the mean of the key's earlier rows."""
    seen = KeySequence(df, keys, order, **slicing).add(
        prior_sum={"_sum": duration}, prior_count={"_count": duration}
    )
    expected = F.try_divide(F.col("_sum").cast("double"), F.col("_count").cast("double"))
    return (
        seen.withColumn("expected", expected)
        .withColumn(
            "is_regression",
            F.coalesce(F.col(duration).cast("double") >= F.col("expected") * factor, F.lit(False)),
        )
        .drop("_sum", "_count")
    )
