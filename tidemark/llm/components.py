"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node of ``edges`` (columns ``a, b``); the label is the least node reachable.

    Alternates large-star and small-star steps until the edges form stars. Each
    round is written to the shared folder, so its lineage stays short; the number
    of rounds grows with the logarithm of the graph. Hot nodes only meet in
    aggregates with partial sums and in joins that AQE can split.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every edge now runs from a node to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        new = stored(small.where(F.col("a") != F.col("b")).distinct(), "edges")
        after = _state(new)
        discard(edges)
        edges = new
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
