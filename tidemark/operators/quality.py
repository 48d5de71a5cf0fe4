"""Data-quality rules, metrics, quarantine and gates.

A rule is a condition that good rows meet. As with an SQL CHECK, a condition that
is NULL does not fail; ``required`` is the rule that rejects NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.typing import convert, misfit
from tidemark.operators.joins import orphans
from tidemark.operators.sequences import KeySequence
from tidemark.operators.sizing import settled
from tidemark.sinks import paths


@dataclass(frozen=True)
class Rule:
    """A code and a condition; the condition is built on use, so rules need no session."""

    code: str
    condition: Callable[[], Column]

    @property
    def holds(self) -> Column:
        return self.condition()

    def violated(self) -> Column:
        return F.coalesce(~self.holds, F.lit(False))


def required(column: str) -> Rule:
    return Rule(f"missing:{column}", lambda: F.col(column).isNotNull())


def in_range(column: str, low=None, high=None) -> Rule:
    def condition() -> Column:
        holds = F.lit(True)
        if low is not None:
            holds = holds & (F.col(column) >= F.lit(low))
        if high is not None:
            holds = holds & (F.col(column) <= F.lit(high))
        return holds

    return Rule(f"range:{column}", condition)


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"pattern:{column}", lambda: F.col(column).rlike(pattern))


def one_of(column: str, values: Sequence) -> Rule:
    return Rule(f"domain:{column}", lambda: F.col(column).isin(*values))


def typed(column: str, kind: str) -> Rule:
    return Rule(f"type:{column}", lambda: ~misfit(F.col(column), convert(F.col(column), kind)))


def error_codes(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(r.violated(), F.lit(r.code)) for r in rules]))


def tag(df: DataFrame, rules: Sequence[Rule], errors: str = "_errors") -> DataFrame:
    """Add the codes of all violated rules."""
    return df.withColumn(errors, error_codes(rules))


def all_hold(rules: Sequence[Rule]) -> Column:
    good = F.lit(True)
    for rule in rules:
        good = good & ~rule.violated()
    return good


def remove_invalid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(all_hold(rules))


def quarantine(df: DataFrame, rules: Sequence[Rule], errors: str = "_errors") -> DataFrame:
    """The rows that violate a rule, with their codes."""
    return tag(df, rules, errors).where(F.size(errors) > 0)


def write_checked(df: DataFrame, rules: Sequence[Rule], path: str, mode: str = "overwrite") -> None:
    """Write valid and quarantined rows in one pass over the input.

    Both sets land in one write, split by the partition column ``checked``; read
    either with ``read_valid`` or ``read_quarantined``.
    """
    state = F.when(F.size("_errors") == 0, F.lit("valid")).otherwise(F.lit("quarantined"))
    tag(df, rules).withColumn("checked", state).write.mode(mode).partitionBy("checked").parquet(path)


def write_quarantined(df: DataFrame, rules: Sequence[Rule], path: str, mode: str = "overwrite") -> tuple[int, int]:
    """Write only the rows that violate a rule, where ``read_quarantined`` finds them; counts of all rows and of these."""
    seen, bad = Observation(), F.size("_errors") > 0
    tagged = tag(df, rules).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"))
    tagged.where(bad).withColumn("checked", F.lit("quarantined")).write.mode(mode).partitionBy("checked").parquet(path)
    return seen.get["rows"], seen.get["bad"]


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("checked = 'valid'").drop("checked", "_errors")


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("checked = 'quarantined'").drop("checked")


# --- metrics -----------------------------------------------------------------


def _count_if(condition: Column) -> Column:
    return F.count_if(condition)


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def _per_column(df: DataFrame, metrics: Mapping[str, Mapping[str, Column]], columns: Sequence[str]) -> DataFrame:
    """One pass over the data, then one output row per column.

    ``metrics`` maps a metric name to an aggregate for each column.
    """
    flat = [
        aggregate[c].alias(f"m{i}_{j}")
        for i, aggregate in enumerate(metrics.values())
        for j, c in enumerate(columns)
    ]
    row = df.agg(F.count(F.lit(1)).alias("row_count"), *flat)
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"m{i}_{j}").alias(name) for i, name in enumerate(metrics)],
        )
        for j, c in enumerate(columns)
    ]
    return row.select("row_count", F.inline(F.array(*cells)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count and percentage of NULL per column."""
    columns = list(columns or df.columns)
    nulls = {c: _count_if(F.col(c).isNull()) for c in columns}
    return _per_column(df, {"null_count": nulls}, columns).withColumn(
        "null_pct", _percent(F.col("null_count"), F.col("row_count"))
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows that have a value, per required column."""
    present = {c: F.count(c) for c in columns}
    return _per_column(df, {"present_count": present}, columns).withColumn(
        "completeness_pct", _percent(F.col("present_count"), F.col("row_count"))
    )


def type_mismatches(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values that do not convert to the declared type, per column."""
    wrong = {c: _count_if(misfit(F.col(c), convert(F.col(c), kind))) for c, kind in types.items()}
    return _per_column(df, {"mismatch_count": wrong}, list(types))


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows checked, failed and passing share per rule, in one pass."""
    flat = [_count_if(r.violated()).alias(f"r{i}") for i, r in enumerate(rules)]
    row = df.agg(F.count(F.lit(1)).alias("row_count"), *flat)
    cells = [
        F.struct(F.lit(r.code).alias("rule"), F.col(f"r{i}").alias("failed_count")) for i, r in enumerate(rules)
    ]
    return row.select("row_count", F.inline(F.array(*cells))).withColumn(
        "pass_pct", _percent(F.col("row_count") - F.col("failed_count"), F.col("row_count"))
    )


def ingest_metrics(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Rows ingested, accepted and rejected."""
    good = all_hold(rules)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("ingested"),
        _count_if(good).alias("accepted"),
        _count_if(~good).alias("rejected"),
    )


def quality_score(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = (), target: float = 99.0) -> DataFrame:
    """Percentage of rows that violate no rule; NULL when there are no rows."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"), _count_if(all_hold(rules)).alias("valid_rows")
    )
    return counted.withColumn("score", _percent(F.col("valid_rows"), F.col("total_rows"))).withColumn(
        "meets_target", F.col("score") > target
    )


def scorecard(df: DataFrame, rules: Sequence[Rule], period: str) -> DataFrame:
    """Score per period and its change since the period before.

    ``df`` carries the period as a column; the trend runs over one row per period,
    in slices where there are more periods than a task should sort.
    """
    scores = settled(quality_score(df, rules, [period]), "scores")
    trend = KeySequence(scores, [], [period]).add(lag={"previous_score": "score"})
    return trend.withColumn("trend", F.col("score") - F.col("previous_score"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows; counts each key first so hot keys combine early."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("violations", F.col("row_count") - F.col("distinct_keys"))


def referential(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Orphaned keys and how many child rows refer to each."""
    missing = orphans(child, parent, child_key, parent_key)
    return missing.groupBy(child_key).agg(F.count(F.lit(1)).alias("orphan_rows"))


def freshness(
    df: DataFrame, ts: str, as_of: Column, sla_hours: float = 6, limit_hours: float = 24, by: Sequence[str] = ()
) -> DataFrame:
    """Age of the newest row: green within the SLA, yellow within the limit, else red.

    ``as_of`` is an argument, never the clock, so a rerun gives the same answer.
    """
    latest = df.groupBy(*by).agg(F.max(F.col(ts).cast("timestamp")).alias("latest"))
    seconds = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("latest")) / 1e6
    status = (
        F.when(F.col("age_hours") <= sla_hours, F.lit("green"))
        .when(F.col("age_hours") <= limit_hours, F.lit("yellow"))
        .otherwise(F.lit("red"))
    )
    return latest.withColumn("age_hours", seconds / 3600.0).withColumn("status", status)


def row_count_check(df: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col("row_count") >= low)
    if high is not None:
        ok = ok & (F.col("row_count") <= high)
    return counted.withColumn("in_bounds", ok)


def column_profile(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values, minimum and maximum per column, in one pass.

    ``exact`` shuffles every distinct value of every column; the default sketch
    ships a few kilobytes per task.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    metrics = {
        "null_count": {c: _count_if(F.col(c).isNull()) for c in columns},
        "distinct_count": {c: distinct(F.col(c)) for c in columns},
        "min_value": {c: F.min(c).cast("string") for c in columns},
        "max_value": {c: F.max(c).cast("string") for c in columns},
    }
    return _per_column(df, metrics, columns)


# --- schema and files --------------------------------------------------------


def schema_findings(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, finding, expected type, actual type) for each difference; no data is read."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    found = []
    for name, kind in want.items():
        if name not in have:
            found.append((name, "missing", kind, None))
        elif have[name] != kind:
            found.append((name, "mistyped", kind, have[name]))
    found += [(name, "extra", None, kind) for name, kind in have.items() if name not in want]
    return found


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``schema_findings`` as a DataFrame."""
    return df.sparkSession.createDataFrame(
        schema_findings(df.schema, expected),
        "column_name string, finding string, expected_type string, actual_type string",
    )


def file_integrity(df: DataFrame) -> DataFrame:
    """Rows and bytes of every file behind a file-based DataFrame."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
        )
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def folder_integrity(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Rows and bytes of every file below ``path``, which ``df`` reads; files without rows count 0.

    Sizes come from the listing, no file is read for them. Spark's own listing leaves
    out files without bytes; their names are added, and only they pass through the driver.
    """
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    every = every.select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"))
    empty = [(name, 0) for name in paths.empty_files(spark, path)]
    every = every.unionByName(spark.createDataFrame(empty, "file_path string, file_size bigint"))
    counted = file_integrity(df).select("file_path", "row_count")
    return every.join(counted, "file_path", "left").fillna(0, ["row_count"])


class QualityError(ValueError):
    """A hard quality gate failed."""


def assert_quality(df: DataFrame, rules: Sequence[Rule], min_rows: int = 1) -> dict[str, int]:
    """Stop the job if rows are too few or any rule is violated; returns the counts.

    All counts come from one aggregation, so the gate costs one pass.
    """
    flat = [_count_if(r.violated()).alias(f"r{i}") for i, r in enumerate(rules)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *flat).first()
    failed = {r.code: row[f"r{i}"] for i, r in enumerate(rules) if row[f"r{i}"]}
    if row["rows"] < min_rows:
        raise QualityError(f"{row['rows']} rows, at least {min_rows} required")
    if failed:
        raise QualityError("violated rules: " + ", ".join(f"{code} ({n} rows)" for code, n in failed.items()))
    return {"rows": row["rows"]}


def assert_share(checked: DataFrame, least_good: float, min_rows: int = 1, name: str = "input") -> float:
    """Stop the job if too small a share of the rows that ``write_checked`` wrote is good; returns the share.

    Counts come from the footers of the files, by the folder that a row is in.
    """
    counts = {state: n for state, n in checked.groupBy("checked").count().collect()}
    return assert_good(sum(counts.values()), counts.get("quarantined", 0), least_good, min_rows, name)


def assert_good(rows: int, bad: int, least_good: float, min_rows: int = 1, name: str = "input") -> float:
    """Stop the job if too few of ``rows`` are good; returns the share."""
    if rows < min_rows:
        raise QualityError(f"{name}: {rows} rows, at least {min_rows} required")
    share = (rows - bad) / rows if rows else 1.0
    if share < least_good:
        raise QualityError(f"{name}: {bad} of {rows} rows are bad, a share of {least_good} must be good")
    return share
