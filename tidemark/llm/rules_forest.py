"""Quality rules whose statistics are judged together by an isolation forest.

``measure`` counts words, symbols, repeated lines and repeated passages of every
whole text. A document that breaks a base rule is rejected at once; the others
get an anomaly score from an isolation forest over rates of those counts: trees
of random splits, each grown on ``TREE_ROWS`` rows, in which odd documents end
after few splits. The forest is grown from a bounded sample (``FIT_ROWS`` rows by
a hash of the key; trees need no more), the threshold is calibrated on all
labelled rows: the one with the best balance of clean rows kept and poor rows
rejected among those that keep ``KEEP_CLEAN`` of the clean ones.

Defined results: NULL and empty texts have counts of zero and fail the base
rules; repeated rows are judged alike; without labelled rows of both kinds the
threshold is ``PLAIN_THRESHOLD``; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, discard, scan, stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
TREES = 100
TREE_ROWS = 256
FIT_ROWS = 20_000
KEEP_CLEAN = 0.99
SCORE_BINS = 1000
PLAIN_THRESHOLD = 0.62
RATES = 7

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    bits = max(1, int(len(numbers)).bit_length())
    key, packed = ids[:n].copy(), 1
    for i in range(1, window):
        if (packed + 1) * bits > 62:  # too wide to pack: replace what there is by its rank
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            packed = -(-int(n).bit_length() // bits)
        key = (key << bits) | ids[i : i + n]
        packed += 1
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[place] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((edge.cumsum() > 0).sum())


def counts(text: str) -> tuple[list[int], list[float]]:
    """The counts of COUNTS, and the rates that the forest sees."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    letters = sum(map(len, words))
    word_chars = len(text) - (size - letters)
    symbols = size - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    upper = size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = size - len(raw.translate(None, b"!?"))
    w, c = max(1, n), max(1, word_chars)
    rates = [
        word_chars / w,
        symbols / w,
        repeated_lines / max(1, len(lines)),
        repeats / w,
        upper / c,
        marks / w,
        raw.count(b"|") / w,
    ]
    return [n, word_chars, symbols, repeated_lines, repeats], rates


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the counts, and ``rates`` for the forest."""
    kind = docs.schema[key].dataType.simpleString()
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def run(batches):
        for batch in batches:
            rows = [counts(x or "") for x in batch.column(1).to_pylist()]
            table = np.array([r[0] for r in rows], np.int64).reshape(len(rows), len(names))
            yield {"key": batch.column(0), **dict(zip(names, table.T)), "rates": [r[1] for r in rows]}

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return scan(rows, f"key {kind}, {COUNTS}, rates array<double>", run)


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in flat arrays; a leaf has feature -1 and the path length that ends there."""

    roots: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score from 0 to 1 of each row; about 0.5 is usual, more is odd."""
        total = np.zeros(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while (active := np.flatnonzero(self.feature[node] >= 0)).size:
                at = node[active]
                below = x[active, self.feature[at]] < self.value[at]
                node[active] = np.where(below, self.left[at], self.right[at])
            total += self.length[node]
        return np.exp2(-total / len(self.roots) / self.usual)


def grow(x: np.ndarray, seed: int = 7) -> Forest:
    random = np.random.default_rng(seed)
    rows = min(TREE_ROWS, len(x))
    deepest = max(1, int(np.ceil(np.log2(max(2, rows)))))
    feature, value, left, right, length, roots = [], [], [], [], [], []

    def node(part: np.ndarray, depth: int) -> int:
        me = len(feature)
        for column, blank in ((feature, -1), (value, 0.0), (left, -1), (right, -1), (length, 0.0)):
            column.append(blank)
        low, high = part.min(0), part.max(0)
        open_ = np.flatnonzero(high > low)
        if depth >= deepest or len(part) < 2 or not len(open_):
            length[me] = depth + float(expected_path(len(part)))
            return me
        j = int(random.choice(open_))
        # strictly above the least value, so both sides get rows
        cut = float(low[j] + (high[j] - low[j]) * (1 - random.random()))
        side = part[:, j] < cut
        feature[me], value[me] = j, cut
        left[me], right[me] = node(part[side], depth + 1), node(part[~side], depth + 1)
        return me

    for _ in range(TREES):
        roots.append(node(x[random.choice(len(x), rows, replace=False)], 0))
    arrays = [np.array(a) for a in (roots, feature, value, left, right, length)]
    return Forest(*arrays, usual=max(1e-9, float(expected_path(rows))))


def with_scores(measured: DataFrame, forest: Forest | None) -> DataFrame:
    """``measured`` with ``score`` in place of ``rates``; 0 without a forest."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column("rates").flatten().to_numpy(zero_copy_only=False).reshape(n, RATES)
            rest = {name: batch.column(name) for name in batch.schema.names if name != "rates"}
            yield rest | {"score": forest.scores(x) if forest else np.zeros(n)}

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in measured.schema.fields if f.name != "rates"]
    return scan(measured, ", ".join([*kept, "score double"]), run)


def calibrate(scored: DataFrame, labels: DataFrame) -> float:
    """Greatest score that a kept document may have, from all labelled rows that pass the base rules."""
    judged = scored.where(~F.col("base_failed")).join(labels, "key")
    bins = (
        judged.groupBy(F.floor(F.col("score") * SCORE_BINS).alias("bin"))
        .agg(F.sum(F.col("clean").cast("long")).alias("clean"), F.sum((~F.col("clean")).cast("long")).alias("poor"))
        .collect()  # at most SCORE_BINS + 1 rows
    )
    clean, poor = np.zeros(SCORE_BINS + 1), np.zeros(SCORE_BINS + 1)
    for row in bins:
        clean[int(row.bin)], poor[int(row.bin)] = row.clean, row.poor
    if not clean.sum() or not poor.sum():
        return PLAIN_THRESHOLD
    kept, rejected = clean.cumsum() / clean.sum(), 1 - poor.cumsum() / poor.sum()
    good = np.where(kept >= KEEP_CLEAN, kept + rejected, -1)
    return float((np.flatnonzero(good == good.max())[-1] + 1) / SCORE_BINS)


def fit(measured: DataFrame, labels: DataFrame, key: str, label: str) -> tuple[Forest | None, float]:
    """Forest and threshold from stored figures; no forest if every row fails the base rules."""
    passing = measured.where(~F.col("base_failed"))
    total = passing.count()
    if not total:
        return None, PLAIN_THRESHOLD
    sample = bounded(passing, F.hash("key", "n_words", "word_chars"), FIT_ROWS, total).select("rates").collect()
    forest = grow(np.array(sorted(r.rates for r in sample)))
    marks = (
        labels.groupBy(F.col(key).alias("key"))
        .agg((F.min(label) == 1).alias("clean"))
        .where(F.col("key").isNotNull() & F.col("clean").isNotNull())
    )
    return forest, calibrate(with_scores(passing.join(marks, "key").drop("clean"), forest), marks)


def _fitted(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str):
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    measured = stored(measure(docs, key, text).withColumn("base_failed", base_failed), "rule-figures")
    return measured, *fit(measured, labels, key, label)


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``key``, counts, ``base_failed``, ``score`` and ``kept`` of every row of ``docs``."""
    measured, forest, threshold = _fitted(docs, labels, key, text, label)
    scored = with_scores(measured, forest)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < threshold)).withColumnRenamed("key", key)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge`` keeps; texts are measured again, not shuffled."""
    measured, forest, threshold = _fitted(docs, labels, key, text, label)
    discard(measured)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            rows = [counts(x or "") for x in batch.column(at).to_pylist()]
            n, repeats = (np.array([r[0][i] for r in rows], np.int64) for i in (0, 4))
            good = (n >= 10) & (100 * repeats <= 20 * n)
            if forest is not None and len(rows):
                good &= forest.scores(np.array([r[1] for r in rows])) < threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
