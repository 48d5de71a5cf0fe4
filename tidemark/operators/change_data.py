"""Upserts, change-data apply, slowly changing dimensions and erasure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleanse import first_per_key
from tidemark.operators.sequences import KeySequence
from tidemark.operators.sizing import small_side


def without_keys(target: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``other``; a NULL key matches a NULL key."""
    named = other.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_key{i}"))
    return target.join(small_side(named), same, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` replaced by ``source`` rows of equal key, plus the new ones.

    ``source`` must be unique by key; NULL keys are equal to each other. Applying
    it twice equals applying it once. Columns found on one side only are NULL for
    rows of the other.
    """
    untouched = without_keys(target, source, keys)
    return untouched.unionByName(source, allowMissingColumns=True)


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of each key by ``order``, for example (time, sequence)."""
    return first_per_key(changes, keys, [F.col(c).desc() for c in order])


def _last_state(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], alive: Column | None = None
) -> DataFrame:
    """Rows of ``target`` and ``changes`` together, the last of each key, without those that are not ``alive``.

    Both sides are read once and meet in one shuffle, after the last row of each
    key has been picked in every task. Two target rows of one key are an error: no
    change could tell which of them it is for.
    """
    values = [c for c in target.columns if c not in keys]
    row = [F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in target.columns]
    never = [F.lit(None).cast(changes.schema[c].dataType).alias(f"o{i}") for i, c in enumerate(order)]
    when = [F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]
    old = target.select(*row, F.struct(F.lit(False).alias("new"), *never).alias("_at"), F.lit(True).alias("_alive"))
    new = changes.select(
        *row, F.struct(F.lit(True).alias("new"), *when).alias("_at"), (F.lit(True) if alive is None else alive).alias("_alive")
    )
    both = old.unionByName(new)
    last = F.max_by(F.struct(*[F.col(f"`{c}`").alias(c) for c in values], F.col("_alive")), F.col("_at")).alias("_last")
    twice = F.count_if(~F.col("_at.new")) > 1
    found = both.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(last, twice.alias("_twice"))
    message = F.concat(F.lit("a key of the target occurs twice: "), F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])))
    sound = F.when(F.col("_twice"), F.raise_error(message).cast("boolean")).otherwise(F.col("_last._alive"))
    picked = {c: F.col(f"_last.`{c}`") for c in values}
    return found.where(sound).select(*[(picked[c] if c in picked else F.col(f"`{c}`")).alias(c) for c in target.columns])


def cdc_apply(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    op: str = "op",
    delete: str = "D",
) -> DataFrame:
    """Apply inserts, updates and deletes; only the last change of a key counts.

    ``target`` has one row per key, and NULL is a key like any other. A change
    without a code says nothing: it is passed over, and ``uncoded`` has it for quarantine.
    """
    return _last_state(target, changes.where(F.col(op).isNotNull()), keys, order, F.col(op) != delete)


def uncoded(changes: DataFrame, op: str = "op") -> DataFrame:
    """Changes that do not say what they do."""
    return changes.where(F.col(op).isNull())


def scd1(dimension: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Type 1: the newest attributes overwrite the old ones; ``dimension`` has one row per key."""
    return _last_state(dimension, changes, [key], order)


def surrogate_key(key: str, valid_from: str) -> Column:
    """Digest of key and start date: the same on every run and in every engine."""
    day = F.date_format(valid_from, "yyyy-MM-dd")
    return F.sha2(F.concat(F.col(key).cast("string"), F.lit("|"), day), 256)


def scd2(
    changes: DataFrame,
    key: str,
    effective: str,
    sequence: str,
    attributes: Sequence[str],
    **slicing,
) -> DataFrame:
    """Type 2 history of a change feed: key, attributes, valid_from, valid_to, is_current.

    Changes may come in any order. Of several at one time the last by
    ``sequence`` counts, and a change that repeats the previous attributes adds
    no version. Intervals are half-open and the newest one has no end. A change
    without a key or an effective time belongs to no interval; the quality rules
    are the place to quarantine it.
    """
    placed = changes.select(key, effective, sequence, *attributes).dropna(subset=[key, effective])
    last = latest_changes(placed, [key, effective], [sequence])
    last = last.withColumn("_attributes", F.struct(*attributes)).drop(sequence)
    sequence_of_changes = KeySequence(last, [key], [effective], **slicing)
    marked = sequence_of_changes.add(lag={"_before": "_attributes", "_previous": effective})
    first = F.col("_previous").isNull()
    changed = marked.where(first | ~F.col("_attributes").eqNullSafe(F.col("_before")))
    ended = KeySequence(changed, [key], [effective], like=sequence_of_changes).add(lead={"valid_to": effective})
    return ended.select(
        key,
        *attributes,
        F.col(effective).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_apply(dimension: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Replace the versions of every key found in ``history``, keep all other keys.

    ``history`` is ``scd2`` over the whole change log of the touched keys, which
    stays right when a change arrives late. Running it twice changes nothing.
    """
    touched = history.select(key).distinct()
    kept = dimension.join(small_side(touched), key, "left_anti")
    return kept.unionByName(history)


def scd2_close_and_insert(
    dimension: DataFrame, changes: DataFrame, key: str, effective: str, attributes: Sequence[str]
) -> DataFrame:
    """Apply one newer change per key: end the current version and start the next.

    For feeds that arrive in order. Changes that repeat the current attributes,
    or are not newer than the current version, leave it as it is.
    """
    incoming = changes.select(
        F.col(key).alias("_key"),
        F.col(effective).alias("_from"),
        F.struct(*attributes).alias("_new"),
    )
    joined = dimension.join(
        small_side(incoming), dimension["is_current"] & (dimension[key] == incoming["_key"]), "left"
    )
    ends = (
        F.col("_key").isNotNull()
        & (F.col("_from") > F.col("valid_from"))
        & ~F.struct(*[F.col(c) for c in attributes]).eqNullSafe(F.col("_new"))
    )
    flagged = joined.withColumn("_ends", F.coalesce(ends, F.lit(False)))
    closed = flagged.select(
        key,
        *attributes,
        "valid_from",
        F.when(F.col("_ends"), F.col("_from")).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & ~F.col("_ends")).alias("is_current"),
    )
    next_versions = flagged.where("_ends").select(
        key,
        *[F.col(f"_new.{c}").alias(c) for c in attributes],
        F.col("_from").alias("valid_from"),
        F.lit(None).cast(dimension.schema["valid_to"].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    new_keys = incoming.join(dimension.select(F.col(key).alias("_key")), "_key", "left_anti").select(
        F.col("_key").alias(key),
        *[F.col(f"_new.{c}").alias(c) for c in attributes],
        F.col("_from").alias("valid_from"),
        F.lit(None).cast(dimension.schema["valid_to"].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return closed.unionByName(next_versions).unionByName(new_keys)


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Versions that were valid at ``moment``."""
    return history.where(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )


def erase(df: DataFrame, subjects: DataFrame, key: str, subject_key: str | None = None) -> DataFrame:
    """Rows of ``df`` that belong to none of the subjects."""
    listed = subjects.select(F.col(subject_key or key).alias("_subject"))
    return df.join(small_side(listed), df[key] == listed["_subject"], "left_anti")
