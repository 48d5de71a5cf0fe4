"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are grown in the driver from a bounded sample (``FIT_ROWS`` distinct
vectors by a hash): each node splits its rows at the median of their projection
on the difference of two of them. Every vector of the table is then filed under
one leaf of each tree. A query walks all trees at once through one priority
queue, ordered by the sum of the squared distances to the splits that a path is on
the wrong side of, until it has found leaves that hold ``SEARCHED`` of the sample's rows, counted once
for each tree. Vectors and queries meet on (tree, leaf); every candidate gets its exact
distance and the nearest are kept, first in each leaf and then over all. So a query computes
about ``SEARCHED`` times as many distances as there are vectors, ``LEAST_SEARCHED`` of the sample's at least.

Equal vectors are one entry with its ``k + 1`` smallest ids: ties go to smaller
ids, so more could never be returned. A leaf grows with the table; it is dealt
into as many parts as keep one near ``BLOCK`` vectors, and only a part is gathered.

Vectors of each length are a table of their own. Lengths with at most ``FEW``
vectors have no forest: all their distances are computed.

Defined results: vectors that are NULL, empty, zero, or that hold
NULL or non-finite components take no part, neither as query nor as candidate;
nor do vectors meet that have another length;
repeated rows (same id, same vector) count once; with fewer candidates all are
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded, scan, stored

FIT_ROWS = 20_000
LEAF_ROWS = 32
TREES = 24
SEARCHED = 0.34
LEAST_SEARCHED = 5000
BLOCK = 4096
FEW = LEAF_ROWS


@dataclass(frozen=True)
class Tree:
    """Inner nodes: normal, offset, children (negative: leaf -1 - child). Leaves: rows of the sample."""

    normal: np.ndarray
    offset: np.ndarray
    child: np.ndarray
    rows: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        out = np.full(len(x), -1, np.int64)
        if not len(self.offset):
            return np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, part = stack.pop()
            right = x[part] @ self.normal[node] > self.offset[node]
            for side, some in ((0, part[~right]), (1, part[right])):
                if len(some):
                    at = int(self.child[node, side])
                    if at < 0:
                        out[some] = -1 - at
                    else:
                        stack.append((at, some))
        return out


def grow(x: np.ndarray, random: np.random.Generator) -> Tree:
    normal, offset, child, rows = [], [], [], []

    def node(part: np.ndarray) -> int:
        if len(part) > LEAF_ROWS:
            for _ in range(5):
                a, b = random.choice(part, 2, replace=False)
                direction = x[a] - x[b]
                if (size := np.linalg.norm(direction)) > 0:
                    along = x[part] @ (direction / size)
                    cut = float(np.median(along))
                    right = along > cut
                    if 0 < right.sum() < len(part):
                        me = len(offset)
                        normal.append(direction / size)
                        offset.append(cut)
                        child.append([0, 0])
                        child[me][0], child[me][1] = node(part[~right]), node(part[right])
                        return me
        rows.append(len(part))
        return -len(rows)

    node(np.arange(len(x)))
    return Tree(np.array(normal).reshape(-1, x.shape[1]), np.array(offset), np.array(child).reshape(-1, 2), np.array(rows))


def search(forest: list[Tree], q: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of the shared queue until their rows reach ``wanted``."""
    products = [t.normal @ q - t.offset if len(t.offset) else None for t in forest]
    heap = [(0.0, t, 0 if len(tree.offset) else -1) for t, tree in enumerate(forest)]
    heapq.heapify(heap)
    found, out = 0, []
    while heap and found < wanted:
        far, t, node = heapq.heappop(heap)
        if node < 0:
            out.append((t, -1 - node))
            found += int(forest[t].rows[-1 - node])
            continue
        margin = float(products[t][node])
        near = 1 if margin > 0 else 0
        heapq.heappush(heap, (far, t, int(forest[t].child[node, near])))
        heapq.heappush(heap, (far + margin * margin, t, int(forest[t].child[node, 1 - near])))
    return out


def usable(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are equal as numbers, so they must be equal as a key
    plain = F.transform(v, lambda x: x + F.lit(0.0))
    return rows.select(F.col(key).cast("long").alias("id"), plain.alias("vector")).where(F.col("id").isNotNull() & finite & some)


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """Each different vector once, with its ``most`` smallest ids, sorted."""
    ranked = rows.withColumn("nth", F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("nth") <= most)
    return ranked.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64, copy=False)


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(
    table: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", seed: int = 3, counts=None
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest others of each query row.

    ``counts``, an accumulator, adds up the distances that were computed in leaves.
    """
    points = usable(table, vector, key).withColumn("n", F.size("vector"))
    sizes = points.groupBy("n").count()
    many = sorted(r.n for r in sizes.where(F.col("count") > FEW).collect())
    asked = points.where(is_query if isinstance(is_query, Column) else F.expr(is_query))
    # components that come as floats travel as floats
    kind = "float" if isinstance(table.schema[vector].dataType.elementType, T.FloatType) else "double"
    out = _all_distances(points.where(~F.col("n").isin(many)), asked, k)
    for n in many:
        part = points.where(F.col("n") == n).select("id", "vector")
        out = out.union(_by_forest(part, asked.where(F.col("n") == n).select("id", "vector"), k, seed, kind, counts))
    return out


def _all_distances(points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The nearest among vectors of the same length, of which there are few."""
    queries = asked.select(F.col("id").alias("query_id"), F.col("vector").alias("q"), "n").distinct()
    pairs = queries.join(points.distinct(), "n").where(F.col("id") != F.col("query_id"))
    squares = F.zip_with("q", "vector", lambda a, b: (a - b) * (a - b))
    score = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    each = pairs.groupBy("query_id", F.col("id").alias("vec_id")).agg(F.min(score).alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by_forest(points: DataFrame, asked: DataFrame, k: int, seed: int, kind: str, counts) -> DataFrame:
    spark = points.sparkSession
    entries = stored(distinct_vectors(points, k + 1), "distinct-vectors")
    total = entries.count()
    sample = bounded(entries, F.col("vector"), FIT_ROWS, total).select("vector").collect()  # bounded by FIT_ROWS
    random, x = np.random.default_rng(seed), np.array(sorted(r.vector for r in sample))
    wanted = max(LEAST_SEARCHED, SEARCHED * len(x))
    # where a query would compute as many distances as there are vectors, one tree has them all once
    forest = [grow(x, random) for _ in range(TREES if wanted < len(x) else 1)]
    parts = max(1, -(-total * LEAF_ROWS // (len(x) * BLOCK)))
    shared = spark.sparkContext.broadcast(forest)
    stored_as = pa.list_(pa.float32() if kind == "float" else pa.float64())

    def file(batches):
        for batch in batches:
            rows = _matrix(batch.column(0))
            first = batch.column(1).flatten().to_numpy()[np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy())[:-1]])]
            for t, tree in enumerate(shared.value):
                leaves = tree.leaves(rows)
                yield {"tree": [t] * len(rows), "leaf": leaves, "part": first % parts, "vector": batch.column(0).cast(stored_as), "ids": batch.column(1)}

    def ask(batches):
        for batch in batches:
            for first, q in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = [(t, leaf, part) for t, leaf in search(shared.value, np.array(q), wanted) for part in range(parts)]
                trees, leaves_, parts_ = map(list, zip(*pairs))
                yield {"tree": trees, "leaf": leaves_, "part": parts_, "q": [q] * len(pairs), "first": [first] * len(pairs)}

    some = entries.where(F.size("ids") > 0).select("vector", "ids")
    filed = scan(some, f"tree int, leaf long, part long, vector array<{kind}>, ids array<long>", file)
    # equal queries are asked once, known by their first id
    queries = stored(asked.distinct(), "queries")
    vectors = queries.groupBy("vector").agg(F.min("id").alias("first"))
    vectors = stored(vectors, "query-vectors")
    leaves = scan(vectors.select("first", "vector"), "tree int, leaf long, part long, q array<double>, first long", ask)

    def meet(key_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"first": [], "ids": [], "score": []}
        if len(left) and len(right):
            c, ids = np.stack(left["vector"].to_numpy()).astype(np.float64), left["ids"].to_numpy()
            if counts is not None:
                counts.add(len(left) * len(right))
            for first, q in zip(right["first"], right["q"]):
                distance = np.sqrt(((c - q) ** 2).sum(1))
                for at in range(0, len(c), BLOCK):
                    part = distance[at : at + BLOCK]
                    best = np.argpartition(part, k)[: k + 1] if len(part) > k + 1 else np.arange(len(part))
                    # all that tie with the last must stay: their ids decide
                    best = np.flatnonzero(part <= part[best].max()) + at
                    out["first"] += [first] * len(best)
                    out["ids"] += list(ids[best])
                    out["score"] += distance[best].tolist()
        # an empty column would otherwise be taken as numbers
        kinds = {"first": "int64", "ids": object, "score": float}
        return pd.DataFrame({name: pd.Series(out[name], dtype=kind) for name, kind in kinds.items()})

    where = ["tree", "leaf", "part"]
    found = filed.groupBy(*where).cogroup(leaves.groupBy(*where))
    found = found.applyInPandas(meet, "first long, ids array<long>, score double")
    # an entry found in several trees counts once
    each = found.select("first", "score", F.explode("ids").alias("vec_id"))
    each = each.groupBy("first", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("first").orderBy("score", "vec_id")
    top = each.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    pairs = queries.join(vectors, "vector").join(top, "first").where(F.col("id") != F.col("vec_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
