"""Exact removal of long repeated passages by a logarithmic family of suffix indexes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else.

Suffixes are sampled: of the ``key``-byte strings inside a window of ``length``
bytes, the leftmost with the least fingerprint is the window's anchor. It depends
on the window alone, so equal windows have equal anchors at equal places, and only
suffixes that start at anchors are indexed (about one in 140 for 400 bytes). Windows in a row with one anchor form a
segment with two fingerprints: of the key bytes at the anchor, and of
all bytes that its windows cover.

Documents are dealt into ``BATCHES`` batches. A batch gives the set of the fingerprints
of its sampled suffixes. The set is joined by equality, with a shuffle, with every
level of the index; what both hold is repeated. Then it becomes a level itself,
and two levels of one size are united into one of twice the size. No suffix array
in text order is built and nothing is merge-scanned: only equal prefixes are asked
for, and these have equal fingerprints.

Segments whose whole text is repeated go; segments whose anchor is not repeated
stay; the few others are cut into pieces of ``PIECE`` windows and then into single
windows, for which the two fingerprints agree. Fingerprints that decide have 128 bits,
two 64-bit hashes of the same bytes, so that 1e12 of them hold no false match but with a chance of 1e-15. One segment stands for all with the same text, so a passage with
any number of copies costs one.

Defined results: a NULL or short text loses nothing; repeated rows are each
other's copies, so all of a text of ``length`` bytes or more goes; rows are told
apart by key and text, also NULL keys; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, discard, mix, prefix_hashes, prefix_hashes_of_pairs, scan, slice_hashes, stored

LENGTH = 400
PIECE = 16
BATCHES = 4
CHUNK = 1 << 22
BROADCAST_NUMBERS = 2_000_000

_POSITION_BITS = 24
_POSITION = np.uint64((1 << _POSITION_BITS) - 1)
_SPAN = np.uint64(0xD6E8FEB86659FD93)


def key_bytes(length: int) -> int:
    """Bytes at an anchor that are indexed: well below the length, so that few anchors are needed."""
    return min(128, length * 8 // 25)


class Prints:
    """Hashes of slices of a text: a 64-bit one, and a second for what must not be taken for equal."""

    def __init__(self, raw: np.ndarray) -> None:
        self.first, self.second = prefix_hashes(raw), prefix_hashes_of_pairs(raw)

    def of(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return slice_hashes(self.first, low, high), slice_hashes(self.second, low + 1, high)

    def spans(self, anchor, low, high, length: int) -> list[np.ndarray]:
        """Of all bytes that windows low..high cover, and of their places around the anchor."""
        places = ((anchor - low).astype(np.uint64) * _SPAN) ^ ((anchor - high).astype(np.uint64) * BASE)
        return [mix(h ^ places).view(np.int64) for h in self.of(low, high + length)]


def anchors_of_windows(prefix: np.ndarray, n: int, length: int = LENGTH) -> np.ndarray:
    """Place of the anchor of each of the windows of a text of ``n`` bytes."""
    key = key_bytes(length)
    starts = np.arange(n - key + 1)
    keys = slice_hashes(prefix, starts, starts + key)
    keys = (keys & ~_POSITION) | starts.astype(np.uint64)  # equal fingerprints: the leftmost
    width = length - key + 1
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    table = padded.reshape(rows, width)
    # least of any window: least from its start to the end of a row, and from there on
    upto = np.minimum.accumulate(table, 1).ravel()
    onward = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    windows = n - length + 1
    return (np.minimum(onward[:windows], upto[width - 1 : width - 1 + windows]) & _POSITION).astype(np.int64)


def segments(raw: bytes, length: int = LENGTH) -> list[np.ndarray]:
    """Anchor, first and last window, and the fingerprints of all segments of a text: two of the key, two of the span."""
    text = np.frombuffer(raw, np.uint8)
    parts = []
    for at in range(0, max(0, len(text) - length + 1), CHUNK):
        piece = text[at : at + CHUNK + length - 1]
        prints = Prints(piece)
        anchor = anchors_of_windows(prints.first, len(piece), length)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(anchor)) - 1
        x = anchor[first]
        key = [h.view(np.int64) for h in prints.of(x, x + key_bytes(length))]
        parts.append((x + at, first + at, last + at, *key, *prints.spans(x, first, last, length)))
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 7


def classes(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct pair, and for each place whether its pair occurs again."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    many = np.empty(len(order), bool)
    many[order] = ~(new & np.append(new[1:], True))
    return order[new], many


def merge_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the intervals start:end."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:], len(start)) - 1]


# A text is known by two hashes of key and text.
UID = ["uid", "uid2"]
FIELDS = [*UID, "anchor", "low", "high", "key", "key2", "span", "span2"]
SEGMENT = ", ".join(f"{f} long" for f in FIELDS)
PRINT = ["print", "print2"]
KEYS, SPANS = ["key", "key2"], ["span", "span2"]


def find_segments(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Segments of all texts (``uid, uid2, raw``): SEGMENT and ``inside``.

    ``inside`` marks what a text repeats within itself: one row for each such
    segment, and rows without key that list all it covers.
    """

    def run(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(len(FIELDS) + 1)]
            for uid, uid2, raw in zip(*(c.to_pylist() for c in batch.columns)):
                found = segments(raw or b"", length)
                if not len(found[0]):
                    continue
                first, many = classes(*found[5:])
                own = np.sort(first)
                start, end = merge_runs(found[1][many], found[2][many] + length)
                blank = np.zeros(len(start), np.int64)
                rows = [np.full(len(own), uid), np.full(len(own), uid2), *(f[own] for f in found), many[own]]
                covers = [np.full(len(start), uid), np.full(len(start), uid2), blank - 1, start, end - length, *[blank] * 4, blank > -1]
                for column, a, b in zip(out, rows, covers):
                    column += [a, b]
            if out[0]:
                columns = [np.concatenate(c) for c in out]
                yield {**dict(zip(FIELDS, columns)), "inside": columns[-1].astype(bool)}

    return scan(docs, f"{SEGMENT}, inside boolean", run)


class SuffixIndex:
    """Levels of fingerprint sets; level i is None or holds 2**i batches."""

    def __init__(self) -> None:
        self.levels: list[DataFrame | None] = []

    def add(self, batch: DataFrame) -> list[DataFrame]:
        """Take in the set ``print`` of a batch; what it shares with each level."""
        shared = [stored(batch.join(level, PRINT, "inner"), "suffix-shared") for level in self.levels if level is not None]
        size = 0
        while size < len(self.levels) and self.levels[size] is not None:
            old = self.levels[size]
            merged = stored(old.union(batch).distinct().sortWithinPartitions(*PRINT), "suffix-level")
            discard(old, batch)
            self.levels[size], batch, size = None, merged, size + 1
        self.levels += [None] * (size + 1 - len(self.levels))
        self.levels[size] = batch
        return shared

    def clear(self) -> None:
        discard(*(x for x in self.levels if x is not None))


def _prints(found: DataFrame, *pairs: list[str]) -> DataFrame:
    """Fingerprints of segments with how often each occurs; what a text repeats within itself counts twice."""
    named = [F.struct(*[F.col(c).alias(p) for c, p in zip(pair, PRINT)]) for pair in pairs]
    prints = found.select(F.inline(F.array(*named)), F.when(F.col("inside"), 2).otherwise(1).alias("n"))
    return prints.groupBy(*PRINT).agg(F.sum("n").alias("n"))


def repeated_prints(found: DataFrame, batches: int) -> DataFrame:
    """Distinct fingerprints (keys and spans) that occur more than once in all segments."""
    index, parts = SuffixIndex(), []
    for b in range(batches):
        mine = found.where((F.col("anchor") >= 0) & (F.pmod(F.xxhash64("uid"), F.lit(batches)) == b))
        counted = stored(_prints(mine.select(*FIELDS[5:], "inside"), KEYS, SPANS), "suffix-batch")
        parts.append(stored(counted.where("n > 1").select(*PRINT), "suffix-shared"))
        array = stored(counted.select(*PRINT).sortWithinPartitions(*PRINT), "suffix-level")
        parts += index.add(array)
        discard(counted)
    index.clear()
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    out = stored(every.distinct(), "suffix-repeated")
    discard(*parts)
    return out


def decide(found: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Covered runs ``uid, low, high`` (of windows), and the segments that need a closer look.

    The latter are all with a repeated key and a span of their own, and one for each
    repeated span of such a key.
    """
    keys, spans = repeated.toDF(*KEYS), repeated.toDF(*SPANS).withColumn("whole", F.lit(True))
    met = found.where("anchor >= 0").join(keys, KEYS).join(spans, SPANS, "left")
    met = stored(met.withColumn("whole", F.coalesce("whole", F.lit(False))), "suffix-met")
    covered = met.where("whole and not inside").select(*UID, "low", "high")
    single = met.where("not whole")
    open_keys = single.select(*KEYS).distinct()
    columns = [*UID, "anchor", "low", "high"]
    example = met.where("whole").join(open_keys, KEYS, "left_semi").groupBy(*KEYS, *SPANS).agg(F.min(F.struct(*columns)).alias("s"))
    closer = single.select(*columns, F.lit(False).alias("known")).union(example.select(*(f"s.{c}" for c in columns), F.lit(True)))
    return covered, closer


def _join_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``docs`` with the arrays of numbers in ``lists`` by uid; the text is only shuffled if they are large."""
    numbers = lists.agg(F.coalesce(F.sum(sum(F.size(c) for c in lists.columns if c not in UID) + 4), F.lit(0))).first()[0]
    return docs.join(F.broadcast(lists) if numbers <= BROADCAST_NUMBERS else lists, UID, how)


def cut(docs: DataFrame, closer: DataFrame, windows: int, length: int = LENGTH) -> DataFrame:
    """Pieces of up to ``windows`` windows of the segments in ``closer``, with their fingerprints."""
    columns = ["anchor", "low", "high", "known"]
    lists = closer.withColumn("known", F.col("known").cast("long")).groupBy(*UID)
    lists = stored(lists.agg(F.flatten(F.sort_array(F.collect_set(F.array(*columns)))).alias("parts")), "suffix-closer")
    rows = _join_lists(docs, lists, "inner").select(*UID, "raw", "parts")

    def run(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(len(FIELDS) + 1)]
            for uid, uid2, raw, parts in zip(*(c.to_pylist() for c in batch.columns)):
                prints = Prints(np.frombuffer(raw, np.uint8))
                x, low, high, known = np.array(parts, np.int64).reshape(-1, 4).T
                # offsets of windows from the anchor fall into bins of equal place in all copies
                first, last = (x - high) // windows, (x - low) // windows
                times = last - first + 1
                which = np.repeat(np.arange(len(x)), times)
                bin_ = first[which] + np.arange(len(which)) - np.repeat(times.cumsum() - times, times)
                x, known = x[which], known[which]
                low_, high_ = np.maximum(low[which], x - (bin_ * windows + windows - 1)), np.minimum(high[which], x - bin_ * windows)
                # all windows of the bin contain these bytes
                place = (bin_.astype(np.uint64) * _SPAN) ^ np.uint64(windows)
                core = prints.of(x - bin_ * windows, x - (bin_ * windows + windows - 1) + length)
                key = [mix(h ^ place).view(np.int64) for h in core]
                span = prints.spans(x, low_, high_, length)
                for column, values in zip(out, (np.full(len(x), uid), np.full(len(x), uid2), x, low_, high_, *key, *span, known)):
                    column.append(values)
            if out[0]:
                values = [np.concatenate(c) for c in out]
                yield {**dict(zip(FIELDS, values)), "inside": values[-1].astype(bool)}

    return scan(rows, f"{SEGMENT}, inside boolean", run)


def find_runs(docs: DataFrame, batches: int = BATCHES, length: int = LENGTH) -> DataFrame:
    """``uid, uid2`` and ``runs`` (starts and ends in turn) of what goes from each text of ``docs`` (``uid, uid2, raw``)."""
    found = stored(find_segments(docs, length), "suffix-segments")
    covered = [found.where("anchor < 0").select(*UID, "low", "high")]
    repeated = repeated_prints(found, batches)
    gone, closer = decide(found, repeated)
    covered.append(gone)
    discard(repeated)
    for windows in (PIECE, 1):
        pieces = stored(cut(docs, closer, windows, length), "suffix-pieces")
        pairs = [SPANS] if windows == 1 else [KEYS, SPANS]  # key and span of a single window say the same
        repeated = stored(_prints(pieces.select(*FIELDS[5:], "inside"), *pairs).where("n > 1").select(*PRINT), "suffix-repeated")
        if windows == 1:
            hits = pieces.where("not inside").join(repeated.toDF(*SPANS), SPANS)
            covered.append(hits.select(*UID, "low", "high"))
        else:
            gone, closer = decide(pieces, repeated)
            covered.append(gone)
    runs = covered[0]
    for part in covered[1:]:
        runs = runs.union(part)
    lists = runs.groupBy(*UID).agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))

    def run(batches_):
        for batch in batches_:
            merged = []
            for low, high in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                start, end = merge_runs(np.array(low), np.array(high) + length)
                merged.append(np.stack([start, end], 1).ravel().tolist())
            yield {"uid": batch.column(0), "uid2": batch.column(1), "runs": merged}

    out = stored(scan(lists, "uid long, uid2 long, runs array<long>", run), "suffix-runs")
    discard(found)
    return out


def _with_uid(docs: DataFrame, key: str, text: str) -> DataFrame:
    # a marker for NULL, which xxhash64 would skip
    named = [F.col(key), F.col(key).isNull(), F.col(text)]
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.withColumns({"uid": F.xxhash64(*named), "uid2": F.xxhash64(F.lit("second"), *reversed(named)), "raw": raw})


def _kept(raw: bytes, runs: list[int]) -> list[bytes]:
    places = [0, *runs, len(raw)]
    return [raw[a:b] for a, b in zip(places[::2], places[1::2])]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, length: int = LENGTH) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    rows = _with_uid(docs.select(key, text), key, text).select(key, *UID, "raw")
    runs = find_runs(rows.select(*UID, "raw"), batches, length)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches_):
        for batch in batches_:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for raw, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept = _kept(raw, gone or [])
                size = sum(map(len, kept))
                for name, value in zip(out, (len(raw), len(raw) - size, len(gone or []) // 2, sha256(b"".join(kept)).hexdigest())):
                    out[name].append(value)
            yield {"key": batch.column(0), **out}

    joined = _join_lists(rows, runs, "left").select(F.col(key).alias("key"), "raw", "runs")
    ddl = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return scan(joined, ddl, run).withColumnRenamed("key", key)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, length: int = LENGTH) -> DataFrame:
    """``docs`` with the remaining text; characters that lost a byte go whole, a NULL text stays NULL."""
    columns = docs.columns
    rows = _with_uid(docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns))), f"c{columns.index(key)}", f"c{columns.index(text)}")
    runs = find_runs(rows.select(*UID, "raw"), batches, length)
    joined = _join_lists(rows.drop("raw"), runs, "left")
    at = columns.index(text)

    def run(batches_):
        for batch in batches_:
            out = {name: batch.column(name) for name in batch.schema.names if name != "runs"}
            pairs = zip(batch.column(f"c{at}").to_pylist(), batch.column("runs").to_pylist())
            out[f"c{at}"] = [b"".join(_kept(t.encode(), gone)).decode("utf-8", "ignore") if gone else t for t, gone in pairs]
            yield out

    wanted = [f"c{i}" for i in range(len(columns))]
    ddl = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in wanted)
    out = scan(joined.select(*wanted, "runs"), ddl, run)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
