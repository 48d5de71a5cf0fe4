"""Deduplication, null handling and outlier flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyed import join_groups, with_group_values
from tidemark.operators.percentiles import exact_percentiles
from tidemark.operators.sizing import settled


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key; ``order`` must be total for a stable result.

    Spark turns the ``= 1`` filter into a group limit before the shuffle, so each
    task ships at most one row per key and duplicates of a hot key never meet.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def impute(df: DataFrame, value: str, keys: Sequence[str], method: str = "mean", **percentile_args) -> DataFrame:
    """Replace NULL by the group's mean or median, or by the overall one if the group has none."""
    if method == "mean":
        grouped = with_group_values(df, keys, _group=F.avg(value))
        overall = df.agg(F.avg(value)).scalar()
    elif method == "median":
        medians = exact_percentiles(df, keys, value, {"_group": 0.5}, **percentile_args)
        grouped = join_groups(df, settled(medians, "medians"), list(keys))
        overall = exact_percentiles(df, [], value, {"_all": 0.5}, **percentile_args).scalar()
    else:
        raise ValueError(f"method must be mean or median, not {method}")
    return grouped.withColumn(value, F.coalesce(F.col(value), F.col("_group"), overall)).drop("_group")


def zscore_outliers(df: DataFrame, value: str, keys: Sequence[str] = (), limit: float = 3.0) -> DataFrame:
    """Add ``z_score`` and ``is_outlier``; rows are flagged, never removed."""
    stats = with_group_values(df, keys, _mean=F.avg(value), _sd=F.stddev_samp(value))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_sd"))
    return (
        stats.withColumn("z_score", z)
        .withColumn("is_outlier", F.coalesce(F.abs("z_score") > limit, F.lit(False)))
        .drop("_mean", "_sd")
    )


def iqr_outliers(
    df: DataFrame, value: str, keys: Sequence[str] = (), reach: float = 1.5, **percentile_args
) -> DataFrame:
    """Add ``is_outlier`` for values beyond ``reach`` quartile ranges outside the quartiles."""
    keys = list(keys)
    fences = exact_percentiles(df, keys, value, {"_q1": 0.25, "_q3": 0.75}, **percentile_args)
    if keys:
        joined = join_groups(df, settled(fences, "fences"), keys)
    else:
        whole = fences.select(F.struct("_q1", "_q3")).scalar()
        joined = df.withColumn("_whole", whole).select(*df.columns, "_whole._q1", "_whole._q3")
    span = (F.col("_q3") - F.col("_q1")) * reach
    outside = (F.col(value) < F.col("_q1") - span) | (F.col(value) > F.col("_q3") + span)
    return joined.withColumn("is_outlier", F.coalesce(outside, F.lit(False))).select(*df.columns, "is_outlier")
