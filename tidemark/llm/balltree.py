"""Ranked lexical search: exact inner products found in sparse ball trees.

A document is a sparse vector: for each of its terms the integer
``w * ((10**9 * tf) div (1000 * tf + 8 * m))``; a query holds how often each term
occurs in it, and the score is their inner product. Only the terms of the queries
matter to any score, so vectors are kept in these dimensions.

1. Queries are read in blocks of bounded size. Their terms are the dimensions.
2. One scan over all whole texts stores term frequencies in these dimensions and
   the number of all terms of each document; document frequencies, the number of documents
   and of terms are counted over all of them.
3. Each task turns its documents into ball trees of at most ``TREE_ROWS`` documents:
   a node is split at the median of the projection on the line between two far
   documents, and has a centroid and the largest distance from it.
4. A tree is searched best-first for every query. No document below a node scores
   more than <q, centroid> + |q| * radius, rounded up, nor more than <q, greatest entries below the
   node>; the lesser is its bound, and a node whose bound is less than
   the k-th best score so far is never opened. Leaves are scored exactly, in 64-bit
   integers.
5. One document of ``PROBE`` is searched first; the k-th best scores found there are
   lower bounds of the final ones and prune the trees of all others. The best of
   both are ranked by score and key.

No documents meet in a shuffle, only the best candidates of each tree. The driver
sees a block of queries, its terms and their document frequencies.

Defined results: a NULL or empty text, or one without terms, is found by no query and not
counted; a NULL or empty query finds nothing; queries are rows that differ in key or text, NULL
keys included; equal scores rank by key, NULL last; repeated documents are ranked each for itself;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, scan, stored

K = 10
# Bytes of query texts in one block, documents and entries of one tree, documents of a leaf.
QUERY_BYTES = 4 * 1024 * 1024
TREE_ROWS = 16_384
TREE_ENTRIES = 6_000_000
LEAF = 32
# One document of so many is searched first.
PROBE = 16
NO_KEY = np.iinfo(np.int64).max

# Terms: ASCII letters (A-Z lower-cased), digits and everything outside ASCII; all else separates.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TERMS).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def entries(tf: np.ndarray, w: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """The integer that each term adds to a score for each time that the query has it."""
    m = 100 - 75 + (75 * n * documents) // all_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Sparse:
    """Rows of sparse non-negative integer vectors, none of them empty."""

    def __init__(self, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> None:
        self.starts, self.index, self.value = starts, index, value

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        sizes = self.starts[rows + 1] - self.starts[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Sparse(starts, self.index[at], self.value[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.value * dense[self.index], self.starts[:-1])


class Tree:
    """A ball tree: nodes in the order of creation, leaves name runs of ``order``."""

    def __init__(self, rows: Sparse, dimensions: int, leaf: int = LEAF) -> None:
        self.order = np.arange(len(rows))
        self.centroids: list[tuple[np.ndarray, np.ndarray]] = []
        self.greatest: list[np.ndarray] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        scratch = np.zeros(dimensions)
        open_ = [self._node(0, len(rows))]
        while open_:
            node = open_.pop()
            low, high = self.span[node]
            part = rows.take(self.order[low:high])
            far, index, value = self._ball(node, part, scratch)
            if high - low <= leaf:
                continue
            side = self._sides(part, far, index, value, scratch)
            self.order[low:high] = self.order[low:high][np.argsort(side, kind="stable")]
            middle = (low + high) // 2
            self.children[node] = self._node(low, middle), self._node(middle, high)
            open_ += self.children[node]
        self.rows = rows.take(self.order)

    def _node(self, low: int, high: int) -> int:
        self.centroids.append((np.empty(0, np.int64), np.empty(0)))
        self.greatest.append(np.empty(0))
        self.radius.append(0.0)
        self.span.append((low, high))
        self.children.append(None)
        return len(self.span) - 1

    def _ball(self, node: int, part: Sparse, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(part.index, kind="stable")
        at = part.index[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        index, value = at[first], np.add.reduceat(part.value[order], first) / len(part)
        self.greatest[node] = np.maximum.reduceat(part.value[order], first).astype(float)
        scratch[index] = value
        own = np.add.reduceat(part.value.astype(float) ** 2, part.starts[:-1])
        centre = float(value @ value)
        # the products are off by a few units in the last place for each entry; the slack is far above that
        slack = 4 * np.finfo(float).eps * (len(index) + 8)
        distance = own - 2 * part.dot(scratch) + centre
        safe = np.maximum(distance, 0) + slack * (own + centre)
        scratch[index] = 0
        self.centroids[node] = index, value
        self.radius[node] = float(np.sqrt(safe.max())) * (1 + 1e-9)
        return distance, index, value

    @staticmethod
    def _sides(part: Sparse, far: np.ndarray, index: np.ndarray, value: np.ndarray, scratch: np.ndarray) -> np.ndarray:
        """Projection of each row on the line between the row farthest from the centroid and the one farthest from that."""
        own = np.add.reduceat(part.value.astype(float) ** 2, part.starts[:-1])

        def products(row: int) -> np.ndarray:
            run = slice(part.starts[row], part.starts[row + 1])
            scratch[part.index[run]] = part.value[run]
            out = part.dot(scratch)
            scratch[part.index[run]] = 0
            return out

        first = int(far.argmax())
        to_first = products(first)
        to_second = products(int((own - 2 * to_first).argmax()))
        return to_second - to_first

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]], dimensions: int) -> np.ndarray:
        """For each node and query a number that no score below the node exceeds."""
        starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in queries])])
        rows = Sparse(starts, np.concatenate([i for i, _ in queries]), np.concatenate([c for _, c in queries]).astype(float))
        norms = np.sqrt(np.add.reduceat(rows.value**2, starts[:-1]))
        dense, out = np.zeros(dimensions), np.empty((len(self.span), len(queries)))
        for node, (index, value) in enumerate(self.centroids):
            dense[index] = value
            ball = rows.dot(dense) + norms * self.radius[node]
            dense[index] = self.greatest[node]
            out[node] = np.minimum(ball, rows.dot(dense))
            dense[index] = 0
        return out * (1 + 1e-9) + 1


def search(tree: Tree, keys: np.ndarray, queries: list, bounds: np.ndarray, floor: list[int], k: int, dimensions: int) -> tuple[list, int]:
    """Best ``(query, key, score)`` of a tree with a score of ``floor`` or more, and the number of documents scored."""
    out, scored = [], 0
    dense = np.zeros(dimensions, np.int64)
    for q, (index, count) in enumerate(queries):
        dense[index] = count
        bound = bounds[:, q]
        best: list[tuple[int, int]] = []  # (score, -key), least first
        least = max(floor[q], 1)
        queue = [(-bound[0], 0)]
        while queue and -queue[0][0] >= least:
            _, node = heapq.heappop(queue)
            if tree.children[node]:
                for child in tree.children[node]:
                    if bound[child] >= least:
                        heapq.heappush(queue, (-bound[child], child))
                continue
            low, high = tree.span[node]
            first, last = tree.rows.starts[low], tree.rows.starts[high]
            scores = np.add.reduceat(
                tree.rows.value[first:last] * dense[tree.rows.index[first:last]], tree.rows.starts[low:high] - first
            )
            scored += high - low
            for at in np.flatnonzero(scores >= least).tolist():
                one = (int(scores[at]), -int(keys[low + at]))
                if len(best) < k:
                    heapq.heappush(best, one)
                elif one > best[0]:
                    heapq.heapreplace(best, one)
            if len(best) == k:
                least = max(least, best[0][0])
        dense[index] = 0
        out += [(q, -key, score) for score, key in best]
    return out, scored


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Queries ``(key, text)`` in lists of about ``QUERY_BYTES``, each collected on its own."""
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // QUERY_BYTES)
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [tuple(r) for r in chosen.collect()]


def _vectors(docs: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """Number of all terms of each document, and its frequencies of those that are in ``words``."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = shared.value
        for batch in batches:
            out: dict[str, list] = {"key": [], "n": [], "idx": [], "tf": []}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                if found:
                    here = Counter(map(known.get, found))
                    here.pop(None, None)
                    out["key"].append(key)
                    out["n"].append(len(found))
                    out["idx"].append(list(here))
                    out["tf"].append(list(here.values()))
            yield out

    plain = docs.select(F.col("doc_id").cast("long"), "text")
    return scan(plain, "key long, n long, idx array<int>, tf array<int>", count)


def _best(vectors: DataFrame, queries: list, weights: np.ndarray, documents: int, all_terms: int, floor: list[int], k: int, counts=None) -> DataFrame:
    """The best ``k`` documents of each tree for each query, as ``q, key, score``."""
    dimensions = len(weights)
    shared = vectors.sparkSession.sparkContext.broadcast((queries, weights, floor))

    def answers(held: list[pa.RecordBatch]) -> dict:
        queries, w, floor = shared.value
        whole = pa.Table.from_batches(held).combine_chunks()
        idx, tf = whole.column("idx").chunk(0), whole.column("tf").chunk(0)
        starts = idx.offsets.to_numpy().astype(np.int64)
        index, tf = idx.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
        n = np.repeat(whole.column("n").to_numpy(), np.diff(starts))
        rows = Sparse(starts - starts[0], index, entries(tf, w[index], n, documents, all_terms))
        keys = whole.column("key").fill_null(NO_KEY).to_numpy()
        tree = Tree(rows, dimensions)
        found, scored = search(tree, keys[tree.order], queries, tree.bounds(queries, dimensions), floor, k, dimensions)
        if counts is not None:
            counts.add(scored)
        return {
            "q": [q for q, _, _ in found],
            "key": [None if key == NO_KEY else key for _, key, _ in found],
            "score": [score for _, _, score in found],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, rows, size = [], 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, TREE_ROWS // 8):
                piece = batch.slice(low, TREE_ROWS // 8)
                held, rows, size = [*held, piece], rows + piece.num_rows, size + len(piece.column("idx").flatten())
                if rows + TREE_ROWS // 8 > TREE_ROWS or size > TREE_ENTRIES:
                    yield answers(held)
                    held, rows, size = [], 0, 0
        if rows:
            yield answers(held)

    return scan(vectors, "q int, key long, score long", run)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, counts=None) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    ``counts``, an accumulator, adds up the documents that were scored, over all queries.
    """
    spark = docs.sparkSession
    key = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {key}, rank int, doc_id long, score long")
    for block in _blocks(items):
        asked = [(item, Counter(terms(text))) for item, text in block]
        asked = [(item, found) for item, found in asked if found]
        words = {w: i for i, w in enumerate(sorted({w for _, found in asked for w in found}))}
        if not words:
            continue
        queries = [
            (np.array([words[w] for w in found], np.int64), np.array(list(found.values()), np.int64)) for _, found in asked
        ]
        vectors = stored(_vectors(docs, words), "search-vectors")
        total = vectors.agg(F.count("*"), F.sum("n")).first()
        holding = np.zeros(len(words), np.int64)
        for i, n in vectors.select(F.explode("idx").alias("i")).groupBy("i").count().collect():
            holding[i] = n
        weights = np.array([weight(total[0], n) for n in holding.tolist()], np.int64)
        some = vectors.where(F.size("idx") > 0)
        probed = F.pmod(F.xxhash64("key", "n"), F.lit(PROBE)) == 0

        def best(rows: DataFrame, floor: list[int]) -> DataFrame:
            return _best(rows, queries, weights, *total, floor, k, counts)  # noqa: B023

        first = stored(_top(best(some.where(probed), [1] * len(queries)), k), "search-probe")
        floor = dict(first.where(F.col("rank") == k).select("q", "score").collect())
        rest = best(some.where(~probed), [floor.get(q, 1) for q in range(len(queries))])
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(asked)], f"q int, item_id {key}")
        top = stored(_top(first.drop("rank").union(rest), k).join(F.broadcast(names), "q"), "search-top")
        discard(vectors, first)
        out = out.union(top.select("item_id", "rank", F.col("key").alias("doc_id"), "score"))
    return out
