"""Erasure of persons from all tables that refer to them, along the lake's key relations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.access import reachable
from tidemark.operators.sizing import small_side, stored
from tidemark.plans.medallion import SILVER, Lake, read_silver, to_gold
from tidemark.sinks import paths
from tidemark.sinks.batch import partition_columns, replace_partitions
from tidemark.sinks.parts import PLACE

# Partitions that a task may write side by side before rows are gathered by partition first.
FEW = 4


@dataclass(frozen=True)
class Relation:
    """Rows of ``table`` belong to the rows of ``parent`` with ``key`` = ``parent_key``."""

    table: str
    key: str
    parent: str
    parent_key: str


# Which rows of the lake belong to a customer, over orders to their lines; gold names the customer itself.
LAKE_RELATIONS = (
    Relation("orders", "o_custkey", "customer", "c_custkey"),
    Relation("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Relation("fact_sales", "customer_id", "customer", "c_custkey"),
)


def _matching(df: DataFrame, key: str, subjects: DataFrame) -> DataFrame:
    named = subjects.select(F.col(subjects.columns[0]).alias("_subject"))
    return df.join(small_side(named), df[key] == named["_subject"], "left_semi")


def _without(df: DataFrame, key: str, subjects: DataFrame) -> DataFrame:
    named = subjects.select(F.col(subjects.columns[0]).alias("_subject"))
    return df.join(small_side(named), df[key] == named["_subject"], "left_anti")


def _marked(old: DataFrame, gone: DataFrame) -> DataFrame:
    return old.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)


def _unmarked(both: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of placed keys that are not among the marked ones; no join, so they are shuffled once for any number of subjects."""
    key = Window.partitionBy(*PLACE, *keys)
    return both.withColumn("_gone", F.max("_gone").over(key)).where(~F.col("_gone")).drop("_gone")


def erase_in_folder(spark: SparkSession, path: str, key: str, subjects: DataFrame) -> tuple[int, int]:
    """Rewrite the partitions of a table folder that hold subjects; (rows erased, partitions rewritten).

    Partitions without them are not written. What is kept is copied first, since a
    partition cannot be read while it is replaced; the copy goes at once.
    """
    if not paths.holds_data(spark, path):
        return 0, 0
    parts = partition_columns(spark, path)
    df = spark.read.parquet(path)
    if key not in df.columns:
        return 0, 0
    found = _matching(df, key, subjects).groupBy(*parts).count().collect()  # one row for each partition
    if not found:
        return 0, 0
    affected = F.lit(not parts)
    for row in found:
        same = F.lit(True)
        for part in parts:
            same &= F.col(part).eqNullSafe(F.lit(row[part]))
        affected = affected | same
    kept = stored(_without(df.where(affected), key, subjects), "kept")
    if parts:
        replace_partitions(kept, path, parts, rebalance=len(found) > FEW, covers=affected)
    else:
        kept.write.mode("overwrite").parquet(path)
    for folder in {unquote(file.rsplit("/", 1)[0]) for file in kept.inputFiles()}:
        paths.delete(spark, folder)
    return sum(row["count"] for row in found), len(found)


def subject_keys(spark: SparkSession, lake: Lake, table: str, subjects: DataFrame, relations: Sequence[Relation]) -> dict[str, DataFrame]:
    """For each table that is reached from ``table``, the keys its rows are known by, at every layer that has them.

    Tables are walked in the order of their distance; the keys of a parent's rows are
    collected from all its copies, since a quarantined order is in no silver table.
    """
    edges = spark.createDataFrame([(r.parent, r.table) for r in relations], "source string, target string")
    order = {r["table"]: r["distance"] for r in reachable(edges, table).collect()}
    keys = {table: subjects}
    for name in sorted(order, key=order.get):
        relation = next(r for r in relations if r.table == name)
        down = [r for r in relations if r.parent == name]
        rows = [df.select(relation.key, *[r.parent_key for r in down]) for df in _copies(spark, lake, name)]
        every = rows[0]
        for other in rows[1:]:
            every = every.union(other)
        own = _matching(every, relation.key, keys[relation.parent])
        for r in down:
            keys[name] = stored(own.select(r.parent_key).dropna().distinct(), f"subject-{name}")
        keys.setdefault(name, keys[relation.parent])
    return keys


def _copies(spark: SparkSession, lake: Lake, name: str) -> list[DataFrame]:
    out = []
    if name in SILVER:
        out.append(read_silver(spark, lake, name))
    for path in (lake.bronze(name), f"{lake.root}/checked/{name}", lake.gold(name)):
        if paths.holds_data(spark, path):
            out.append(spark.read.parquet(path))
    return out


def erase_everywhere(
    spark: SparkSession, lake: Lake, subjects: DataFrame, table: str = "customer", key: str = "c_custkey",
    relations: Sequence[Relation] = LAKE_RELATIONS,
) -> DataFrame:
    """Erase the rows of ``subjects`` (one column of keys) from bronze, quarantine, silver and gold; returns the report.

    Silver versions that hold erased rows are deleted with them, and the marts of the
    years that lost sales are built again. The report has a row per layer and
    table: rows erased, partitions (or parts) rewritten, and rows left, which must be 0.
    """
    subjects = stored(subjects.select(F.col(subjects.columns[0]).alias(key)).distinct(), "subjects")
    keys = subject_keys(spark, lake, table, subjects, relations)
    known_by = {table: key} | {r.table: r.key for r in relations}
    of = {name: subjects if name == table else keys[next(r.parent for r in relations if r.table == name)] for name in known_by}
    report = []
    # while the sales still tell which months they are in
    sales = lake.gold("fact_sales")
    facts = spark.read.parquet(sales) if paths.exists(spark, sales) else None
    months = [] if facts is None else [
        r[0] for r in _matching(facts, "customer_id", subjects).select(F.col("year") * 12 + F.col("month") - 1).distinct().collect()
    ]
    versions = dict(lake.pointer(spark).get())
    for name, column in known_by.items():
        for layer, path in (("bronze", lake.bronze(name)), ("quarantine", f"{lake.root}/checked/{name}")):
            if paths.exists(spark, path):
                report.append((layer, name, *erase_in_folder(spark, path, column, of[name])))
        if name in SILVER and name in versions:
            silver = lake.silver(spark, name)
            row_keys = list(SILVER[name].keys)
            named = silver.read(versions[name]).select(*dict.fromkeys([*row_keys, column]))
            gone = stored(_matching(named, column, of[name]).select(*row_keys), "lost")
            count = gone.count()
            if count:
                before = silver.manifest(versions[name])
                after = silver.merge(gone, _marked, before.version + 1, before.notes, settle=partial(_unmarked, keys=row_keys))
                versions[name] = after.version
                parts = sum(before.folders.get(p) != after.folders.get(p) for p in set(before.folders) | set(after.folders))
                report.append(("silver", name, count, parts))
            else:
                report.append(("silver", name, 0, 0))
    lake.pointer(spark).set(versions)
    for name in SILVER:
        if name in versions:
            lake.silver(spark, name).forget(versions[name])
    if facts is not None:
        lost = _matching(facts, "customer_id", subjects).count()
        to_gold(spark, lake, months=months)
        report.append(("gold", "fact_sales", lost, len(months)))
        report.append(("gold", "fact_revenue_monthly", 0, len({m // 12 for m in months})))
    left = [(layer, name, _left(spark, lake, layer, name, known_by.get(name), of.get(name))) for layer, name, *_ in report]
    out = spark.createDataFrame(report, "layer string, table string, rows_erased long, parts_rewritten long")
    return out.join(F.broadcast(spark.createDataFrame(left, "layer string, table string, rows_left long")), ["layer", "table"])


def _left(spark: SparkSession, lake: Lake, layer: str, name: str, key: str | None, subjects: DataFrame | None) -> int:
    """Rows of the subjects that a layer still holds."""
    if key is None:
        return 0
    if layer == "silver":
        silver = lake.silver(spark, name)
        return sum(_matching(silver.read(v), key, subjects).count() for v in silver.versions())
    path = {"bronze": lake.bronze(name), "quarantine": f"{lake.root}/checked/{name}", "gold": lake.gold(name)}[layer]
    if not paths.holds_data(spark, path):
        return 0
    df = spark.read.parquet(path)
    return _matching(df, key, subjects).count() if key in df.columns else 0
