"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in blocks (runs of at most ``BLOCK_ROWS`` rows of one input partition),
and go to cells (equal parts of a shard). How many rows of each block go to each
cell is drawn first, such that every row and column of that matrix has its exact
sum and the joint law is that of a uniform permutation. Each block then deals its
rows out in a random order, the rows are exchanged once, and each cell puts what
it received into a random order of its own. As all cell sizes are known before the
exchange, slots need no second count.

The matrix is never held anywhere: it is defined by a binary tree over the blocks.
A node knows how many of its rows each cell gets and splits these counts between its
halves by a multivariate hypergeometric draw, seeded by the node; a task walks from
the root to the blocks it reads. Only the block sizes pass through the driver, one
number for each input partition and million rows.

Defined results: an empty table gives no rows; NULL keys, NULL texts, ties and repeated
rows are rows like any other; a column of ``docs`` that is named like a new one is
replaced. Rows with equal texts are dealt independently. Given the same input partitions
and seed, reruns agree: the rows are written with their block and place before anything
is drawn, so that lost executors recompute the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import release, stored

SHARDS = 16
SEED = 20_240_817
# Rows of one block, whose order is drawn in the memory of a task, and of one cell, which one task sorts.
BLOCK_ROWS = 1 << 20
CELL_ROWS = 100_000
# Longest population that numpy draws from; above, draws invert the distribution.
NUMPY_MOST = 1_000_000_000 - 1


def _by_inversion(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """A hypergeometric draw for populations of any size, by the ratios of neighbouring probabilities.

    Sums the probabilities within 14 standard deviations of the mode; what lies
    outside is far below the precision of a double.
    """
    least, most = max(0, drawn - bad), min(good, drawn)
    if least == most:
        return least
    mode = min(most, max(least, (drawn + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    deviation = math.sqrt(drawn * share * (1 - share) * (1 - drawn / (good + bad)))
    reach = int(14 * deviation) + 40
    low, high = max(least, mode - reach), min(most, mode + reach)
    x = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - x) / (x + 1) * ((drawn - x) / (bad - drawn + x + 1)))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def draw_counts(rng: np.random.Generator, counts: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows, taken without replacement, come from each of the ``counts``."""
    total = int(counts.sum())
    if total <= NUMPY_MOST:
        return rng.multivariate_hypergeometric(counts, drawn, method="marginals")
    taken = np.zeros_like(counts)
    for i, count in enumerate(counts.tolist()):
        if not drawn:
            break
        total -= count
        taken[i] = _by_inversion(rng, count, total, drawn)
        drawn -= int(taken[i])
    return taken


class Matrix:
    """Rows of the communication matrix, each found on its own by walking the tree over the blocks."""

    def __init__(self, starts: np.ndarray, cells: np.ndarray, seed: int) -> None:
        self.starts, self.cells, self.seed = starts, cells, seed

    def row(self, block: int) -> np.ndarray:
        low, high, counts = 0, len(self.starts) - 1, self.cells
        while high - low > 1:
            middle = (low + high) // 2
            rng = np.random.default_rng([self.seed, 0, low, high])
            left = draw_counts(rng, counts, int(self.starts[middle] - self.starts[low]))
            low, high, counts = (low, middle, left) if block < middle else (middle, high, counts - left)
        return counts


def cell_sizes(total: int, shards: int, parts: int) -> np.ndarray:
    """Rows of each of the ``shards * parts`` cells: shards differ by one row at most, and so do parts of a shard."""
    shard, part = np.divmod(np.arange(shards * parts), parts)
    whole = total // shards + (shard < total % shards)
    return whole // parts + (part < whole % parts)


def _slot(cell: Column, place: Column, total: int, shards: int, parts: int) -> tuple[Column, Column]:
    shard, part = F.floor(cell / F.lit(parts)), cell % F.lit(parts)
    whole = F.lit(total // shards) + (shard < total % shards).cast("long")
    before = part * F.floor(whole / F.lit(parts)) + F.least(part.cast("long"), whole % F.lit(parts))
    return shard.cast("int"), (before + place).cast("long")


def uniform_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    Every assignment of rows to slots is equally likely, and shard sizes differ by
    one row at most.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    number = F.monotonically_increasing_id()
    within = number.bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.spark_partition_id().alias("split"), within.alias("place")),
        "shard-rows",
    )
    run = F.floor(F.col("place") / F.lit(block_rows))
    sizes = placed.groupBy("split", run.alias("run")).count().toPandas().sort_values(["split", "run"])
    total = int(sizes["count"].sum())
    shape = T.StructType([placed.schema["row"], T.StructField("cell", T.IntegerType()), T.StructField("draw", T.LongType())])
    if not total:
        empty = docs.sparkSession.createDataFrame([], shape)
        return empty.select("row.*", F.col("cell").alias("shard"), F.col("draw").alias("slot"))
    parts = max(1, -(-total // (shards * cell_rows)))
    names = sizes["split"].to_numpy(np.int64) << 40 | sizes["run"].to_numpy(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes["count"].to_numpy(np.int64))])
    shared = docs.sparkSession.sparkContext.broadcast((names, starts, cell_sizes(total, shards, parts)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, starts, cells = shared.value
        matrix = Matrix(starts, cells, seed)
        held, order, draws = -1, None, None
        for batch in batches:
            place = batch.column("place").to_numpy()
            runs, at = np.divmod(place, block_rows)
            blocks = np.searchsorted(names, batch.column("split").to_numpy().astype(np.int64) << 40 | runs)
            cell, draw = np.empty(len(place), np.int32), np.empty(len(place), np.int64)
            for block in np.unique(blocks).tolist():
                if block != held:
                    rng = np.random.default_rng([seed, 1, block])
                    order = np.repeat(np.arange(len(cells), dtype=np.int32), matrix.row(block))
                    rng.shuffle(order)
                    draws = rng.integers(-(2**63), 2**63 - 1, len(order))
                    held = block
                here = blocks == block
                cell[here], draw[here] = order[at[here]], draws[at[here]]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(cell), pa.array(draw)], names=["row", "cell", "draw"])
        release()

    dealt = placed.mapInArrow(deal, shape)
    place = F.row_number().over(Window.partitionBy("cell").orderBy("draw")) - 1
    shard, slot = _slot(F.col("cell"), place, total, shards, parts)
    return dealt.select("row.*", shard.alias("shard"), slot.alias("slot"))


def write_shards(sharded: DataFrame, path: str, cell_rows: int = CELL_ROWS) -> None:
    """One folder per shard, with files of at most ``cell_rows`` rows in the order of the slots."""
    run = F.floor(F.col("slot") / F.lit(cell_rows))
    placed = sharded.repartition("shard", run).sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").option("maxRecordsPerFile", cell_rows).parquet(path)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text plus 1) and ``text_crc32``; a NULL text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The place of each document, without its text."""
    sharded = uniform_shards(measured(docs), shards)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
