"""Row and column policies, paged reads and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import small_side


def rows_for_role(df: DataFrame, policy: DataFrame, role: str, column: str, attribute: str = "attribute") -> DataFrame:
    """Rows whose ``column`` the policy table (role, attribute) grants to the role."""
    granted = policy.where(F.col("role") == role).select(F.col(attribute).alias("_granted"))
    return df.join(small_side(granted), df[column] == granted["_granted"], "left_semi")


def columns_for_role(df: DataFrame, policy: DataFrame, role: str) -> DataFrame:
    """The columns that the policy table (role, column_name) shows to the role.

    The collected list is bounded by the number of columns of ``df``.
    """
    shown = policy.where((F.col("role") == role) & F.col("column_name").isin(df.columns))
    names = {r["column_name"] for r in shown.select("column_name").distinct().collect()}
    return df.select(*[c for c in df.columns if c in names])


def keyset_page(df: DataFrame, key: str, cursor=None, size: int = 10_000) -> DataFrame:
    """The next ``size`` rows by unique ``key`` after ``cursor``.

    The cursor is a pushed-down filter and the limit a top-k, so a page costs one
    scan and no full sort, however deep it lies.
    """
    rest = df if cursor is None else df.where(F.col(key) > F.lit(cursor))
    return rest.orderBy(key).limit(size)


def reachable(edges: DataFrame, start: str, upstream: bool = False, folder: str | None = None) -> DataFrame:
    """Tables that depend on ``start`` (or that it depends on), with their distance.

    ``edges`` has columns source and target. Each step joins only the tables
    found in the step before, and tables met already are not followed again, so
    diamonds and cycles end. Steps are written to ``folder`` to keep plans short.
    """
    from tidemark.session import scratch

    spark = edges.sparkSession
    here, there = ("target", "source") if upstream else ("source", "target")
    folder = folder or scratch(spark, "lineage")
    schema = "table string, distance int"
    level = 0
    spark.createDataFrame([(start, 0)], schema).write.parquet(f"{folder}/level=0")
    while True:
        known = spark.read.schema(schema).parquet(*[f"{folder}/level={i}" for i in range(level + 1)])
        frontier = spark.read.schema(schema).parquet(f"{folder}/level={level}")
        step = (
            edges.join(frontier, edges[here] == frontier["table"])
            .select(F.col(there).alias("table"))
            .distinct()
            .join(known.select("table"), "table", "left_anti")
            .withColumn("distance", F.lit(level + 1))
        )
        step.write.parquet(f"{folder}/level={level + 1}")
        level += 1
        if spark.read.schema(schema).parquet(f"{folder}/level={level}").isEmpty():
            return known.where("distance > 0")
