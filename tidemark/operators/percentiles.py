"""Exact percentiles per group, by rounds of counts around the wanted ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import join_groups
from tidemark.operators.sizing import known_few, small_side, stored

BINS = 1024
# An interval with no more rows is sorted; a row of it is a double.
FEW_ROWS = 100_000


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: Mapping[str, float],
    few_rows: int = FEW_ROWS,
    bins: int = BINS,
) -> DataFrame:
    """One row per group with linearly interpolated percentiles of ``value``; NULL for a group without values.

    A percentile needs the values at one or two ranks. Each rank starts with the
    interval from the least to the greatest value of its group. Every round reads
    the rows once, counts those of each open interval in ``bins`` bins, with the ends of
    what is in them, and keeps the bin that holds the rank. Bins are equally wide, or equally wide in the exponent of the value or
    of its distance from the low end, in turn, so long tails come apart as well. An interval that has shrunk to one
    value is done; one with at most ``few_rows`` rows is sorted. Counts combine
    before the shuffle, so neither a hot group nor a common value meets in one task. Rows are
    counted, not estimated, so nothing depends on how well files are compressed; a count is spared where ``known_few``
    tells it, and of small files of numbers, however many rows they hold, ``percentile`` keeps each distinct value once.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    everything = F.percentile("_v", list(percentiles.values())).alias("_all")
    grouped = rows.groupBy(*keys).agg(everything).select(*keys, *[F.get("_all", i).alias(name) for i, name in enumerate(percentiles)])
    if known_few(rows, few_rows):  # files measured before: not run to be counted
        return grouped
    present = rows.where(F.col("_v").isNotNull())
    measures = [F.count("_v").alias("_total"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]
    groups = stored(rows.groupBy(*keys).agg(*measures), "groups")
    if (groups.agg(F.max("_total")).first()[0] or 0) <= few_rows:  # every interval is small from the start
        return grouped

    ends = []
    for p in percentiles.values():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        ends += [F.floor(at).cast("long"), F.ceil(at).cast("long")]
    wanted = groups.where(F.col("_total") > 0).withColumn("_rank", F.explode(F.array_distinct(F.array(*ends))))
    columns = [*keys, "_rank", "_low", "_high", "_before", "_n"]
    state = stored(wanted.select(*keys, "_rank", "_low", "_high", F.lit(0).cast("long").alias("_before"), F.col("_total").alias("_n")), "ranks")
    number = 0
    while not state.where((F.col("_low") < F.col("_high")) & (F.col("_n") > few_rows)).isEmpty():
        state = stored(_narrowed(present, state, keys, bins, number).select(*columns), "ranks")
        number += 1
    found = stored(_picked(present, state, keys).select(*keys, "_rank", "_value"), "values")

    values = F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_values")
    answers = found.groupBy(*keys).agg(values)
    joined = join_groups(groups, answers, keys) if keys else groups.withColumn("_values", answers.scalar())
    out = []
    for name, p in percentiles.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        share = at - F.floor(at)
        low, high = F.col("_values")[F.floor(at).cast("long")], F.col("_values")[F.ceil(at).cast("long")]
        out.append(F.when(share == 0, low).otherwise(low * (1 - share) + high * share).alias(name))
    return joined.select(*keys, *out)


def _members(rows: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row once for every interval of its group that it lies in: at most two for each percentile."""
    listed = intervals.groupBy(*keys).agg(F.collect_set(F.struct("_low", "_high")).alias("_open"))
    listed = stored(listed, "intervals")
    joined = join_groups(rows, listed, keys) if keys else rows.withColumn("_open", listed.scalar())
    inside = F.filter("_open", lambda i: (i["_low"] <= F.col("_v")) & (F.col("_v") <= i["_high"]))
    return joined.select(*keys, "_v", F.explode(inside).alias("_i")).select(*keys, "_v", "_i._low", "_i._high")


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], bins: int, number: int) -> DataFrame:
    """``state`` with the intervals of one round closer around their ranks."""
    open_ = state.where(F.col("_low") < F.col("_high"))
    low, high, v = F.col("_low") / 2, F.col("_high") / 2, F.col("_v") / 2  # halves, whose difference is finite
    share = (v - low) / (high - low)
    if number % 3 == 1:  # by sign and exponent of the value
        def power(x):
            return F.signum(x) * F.when(x == 0, 0.0).otherwise(F.log2(F.abs(x)) + 1080)

        share = (power(F.col("_v")) - power(F.col("_low"))) / F.nullif(power(F.col("_high")) - power(F.col("_low")), F.lit(0.0))
        share = F.coalesce(share, F.lit(0.0))
    elif number % 3 == 2:  # by the exponent of the distance from the low end
        share = F.when(share > 0, 1 + F.greatest(F.log2(share), F.lit(-1022.0)) / 1022).otherwise(F.lit(0.0))
    # NaN is above all numbers and infinite ends leave no share: each gets an end of its own
    place = F.when(F.col("_v") == F.col("_low"), -1).when(F.col("_v") == F.col("_high"), bins)
    place = place.when(F.isnan(share), F.floor(F.lit(bins / 2))).otherwise(F.least(F.lit(bins - 1), F.floor(share * bins)))
    interval = [*keys, "_low", "_high"]
    counted = _members(rows, open_, keys).groupBy(*interval, place.cast("int").alias("_bin"))
    counted = counted.agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    cells = F.sort_array(F.collect_list(F.struct("_bin", "_c", "_least", "_most"))).alias("_cells")
    cells = stored(counted.groupBy(*interval).agg(cells), "bins")
    right = cells.withColumnsRenamed({c: f"_r{c}" for c in interval})
    same = F.lit(True)
    for c in interval:
        same &= F.col(c).eqNullSafe(F.col(f"_r{c}"))
    joined = state.join(small_side(right), same, "left")
    start = F.struct(F.col("_before").alias("b"), F.lit(None).cast("double").alias("l"), F.lit(None).cast("double").alias("h"), F.lit(0).cast("long").alias("n"))
    walked = F.aggregate(
        "_cells",
        start,
        lambda a, c: F.when(a["l"].isNotNull(), a)
        .when(F.col("_rank") < a["b"] + c["_c"], F.struct(a["b"].alias("b"), c["_least"].alias("l"), c["_most"].alias("h"), c["_c"].alias("n")))
        .otherwise(F.struct((a["b"] + c["_c"]).alias("b"), a["l"].alias("l"), a["h"].alias("h"), a["n"].alias("n"))),
    )
    placed = joined.withColumn("_w", F.when(F.col("_cells").isNotNull(), walked))
    fresh = lambda name, old: F.coalesce(F.col(f"_w.{name}"), F.col(old)).alias(old)
    return placed.select(*keys, "_rank", fresh("l", "_low"), fresh("h", "_high"), fresh("b", "_before"), fresh("n", "_n"))


def _picked(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The value at each rank: that of an interval of one value, or from the sorted rows of a small one."""
    interval = [*keys, "_low", "_high"]
    done = state.where(F.col("_low") >= F.col("_high")).withColumn("_value", F.col("_low"))
    open_ = state.where(F.col("_low") < F.col("_high"))
    values = _members(rows, open_, keys).groupBy(*interval).agg(F.sort_array(F.collect_list("_v")).alias("_sorted"))
    right = values.withColumnsRenamed({c: f"_r{c}" for c in interval})
    same = F.lit(True)
    for c in interval:
        same &= F.col(c).eqNullSafe(F.col(f"_r{c}"))
    sorted_ = open_.join(right, same).withColumn("_value", F.get("_sorted", (F.col("_rank") - F.col("_before")).cast("int")))
    return done.select(*keys, "_rank", "_value").union(sorted_.select(*keys, "_rank", "_value"))
