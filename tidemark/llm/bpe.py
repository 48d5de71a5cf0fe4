"""Byte-level BPE by numpy matrices, one row for each distinct piece of text.

Texts are cut at single spaces, and the distinct parts of a batch by the
vocabulary's pattern into pieces. A piece that is in the vocabulary is
one token. The others are put into matrices by length bucket, a row of byte
tokens each, padded with -1. In every round each row merges its leftmost pair of
least rank: a hash table in two arrays (open addressing) gives the rank of each
neighbouring pair, ``argmin`` picks the pair, the row is compacted by a shifted
copy, and rows without a mergeable pair leave the matrix. Pieces of more than
``LONGEST`` bytes, for which a matrix of rounds would cost the square of their
length, are merged with a heap over a linked list: the same merges in the same
order, in n log n. Ids stay in arrays: those of a text are gathered from its parts'.

Decoding joins the bytes of the ids.

Defined results: a NULL or empty text has no ids; repeated rows are encoded
alike; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gc
import heapq
import re
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scan

LONGEST = 256
# Cells of one matrix.
CELLS = 2_000_000
# Pieces that are remembered from batch to batch, and their bytes.
CACHED = 200_000
CACHED_BYTES = 16_000_000
ROWS = 500
NO_PAIR = np.iinfo(np.int32).max
# What str.isspace() takes for white space, for Arrow.
_SPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WIDE_SPACE = f"{_SPACE} | {_SPACE}"
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class Ragged:
    """Rows of numbers in one array: row i is ``flat[start[i] : start[i] + count[i]]``."""

    def __init__(self, flat: np.ndarray, count: np.ndarray, start: np.ndarray | None = None):
        self.flat, self.count = flat, count
        self.start = count.cumsum() - count if start is None else start

    def take(self, rows: np.ndarray) -> Ragged:
        """These rows, one after another."""
        count = self.count[rows]
        at = np.repeat(self.start[rows] - (count.cumsum() - count), count)
        at += np.arange(len(at))
        return Ragged(self.flat[at], count)

    def of(self, lists: Ragged) -> Ragged:
        """For each row of ``lists``, which are numbers of rows here, all that these rows hold."""
        taken = self.take(lists.flat)
        ends = np.append(0, taken.count.cumsum())
        return Ragged(taken.flat, ends[lists.start + lists.count] - ends[lists.start], ends[lists.start])

    def __add__(self, other: Ragged) -> Ragged:
        both = np.concatenate([self.flat, other.flat])
        return Ragged(both, np.append(self.count, other.count), np.append(self.start, other.start + len(self.flat)))

    def __len__(self) -> int:
        return len(self.count)


def _joined(parts: list[tuple[np.ndarray, Ragged]], n: int) -> Ragged:
    """``n`` rows from parts that hold some of them each, with their numbers."""
    count, start, at = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for rows, part in parts:
        count[rows], start[rows], at = part.count, part.start + at, at + len(part.flat)
    return Ragged(np.concatenate([p.flat for _, p in parts]) if parts else np.zeros(0, np.int32), count, start)


def _bytes_of(pieces: pa.Array) -> Ragged:
    """The bytes of an Arrow array of texts."""
    _, offsets, data = pieces.buffers()
    if not len(pieces):
        return Ragged(np.zeros(0, np.uint8), np.zeros(0, np.int64))
    ends = np.frombuffer(offsets, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
    return Ragged(np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), np.diff(ends), ends[:-1])


class PairTable:
    """Rank of a pair of tokens, looked up for whole arrays at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (2 * max(1, len(pairs))).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NO_PAIR, np.int32)
        left, right = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        keys, ranks = (left << 32) | right, np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slot(keys)
        while len(keys):  # the first of those that want a slot gets it, the others try the next
            free = np.flatnonzero(self.keys[slots] == -1)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.ranks[slots[placed]] = keys[placed], ranks[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, ranks, slots = keys[rest], ranks[rest], (slots[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MULTIPLY) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_PAIR where there is none or a side is padding."""
        out = np.full(left.shape, NO_PAIR, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[open_].astype(np.int64) << 32) | right.ravel()[open_]
        slots, flat = self._slot(keys), out.reshape(-1)
        while len(open_):
            found = self.keys[slots]
            hit = found == keys
            flat[open_[hit]] = self.ranks[slots[hit]]
            more = ~hit & (found != -1)
            open_, keys, slots = open_[more], keys[more], (slots[more] + 1) & (len(self.keys) - 1)
        return out


class Vocabulary:
    """Ranks of a rank file with its pattern; encodes and decodes without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.raw = pa.array(self.bytes_of, pa.large_binary())
        self.decimal = pa.array([b"%d" % i for i in range(len(self.bytes_of))], pa.large_binary())
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pairs = PairTable(pairs)
        del pairs
        # what was met lately, after the tokens themselves
        self.tokens = pa.array(list(ranks), pa.binary())
        self.token_ids = Ragged(np.fromiter(ranks.values(), np.int32, len(ranks)), np.ones(len(ranks), np.int64))
        self.known, self.known_ids = self.tokens, self.token_ids

    def merge_rows(self, pieces: Ragged) -> Ragged:
        """Merge pieces of similar length, given as bytes, all in one matrix."""
        width = int(pieces.count.max())
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < pieces.count[:, None]] = self.byte_ids[pieces.flat]
        out: list[tuple[np.ndarray, Ragged]] = []
        rows = np.arange(len(pieces))
        ranks = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1)  # the leftmost of the least
            every = np.arange(len(rows))
            best = ranks[every, at]
            done = best == NO_PAIR
            if done.any():
                go, ended = ~done, ids[done]
                used = ended >= 0
                out.append((rows[done], Ragged(ended[used], used.sum(1))))
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                if not len(rows):
                    break
                used = int((ids >= 0).sum(1).max())
                ids, ranks = ids[:, :used], ranks[:, : max(1, used - 1)]
            every = np.arange(len(rows))
            ids[every, at] = best
            # drop the token right of the merge; the pairs left and right of it get new ranks
            columns = np.arange(ids.shape[1] - 1)
            ids = np.where(columns <= at[:, None], ids[:, :-1], ids[:, 1:])
            if ids.shape[1] == 1:
                ranks = np.full((len(rows), 1), NO_PAIR, np.int32)
                continue
            columns = columns[:-1]
            ranks = np.where(columns < at[:, None], ranks[:, :-1], ranks[:, 1:])
            for shift in (-1, 0):
                place = at + shift
                some = np.flatnonzero((place >= 0) & (place < ranks.shape[1]))
                where = place[some]
                ranks[some, where] = self.pairs.lookup(ids[some, where], ids[some, where + 1])
        return _joined(out, len(pieces))

    def pair_rank(self, pair: tuple[int, int]) -> int | None:
        """Rank of one pair."""
        rank = int(self.pairs.lookup(np.array(pair[:1], np.int32), np.array(pair[1:], np.int32))[0])
        return None if rank == NO_PAIR else rank

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, by a heap of pairs over a linked list."""
        ids = [int(x) for x in self.byte_ids[np.frombuffer(piece, np.uint8)]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        row = np.array(ids, np.int32)
        first = self.pairs.lookup(row[:-1], row[1:]).tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != NO_PAIR]
        heapq.heapify(heap)
        seen: dict[tuple[int, int], int | None] = {}  # the few pairs of this piece

        def rank_of(pair: tuple[int, int]) -> int | None:
            if pair not in seen:
                seen[pair] = self.pair_rank(pair)
            return seen[pair]

        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of((ids[i], ids[j])) != rank:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if a >= 0 and b < n and (r := rank_of((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([x for x in ids if x >= 0], np.int32)

    def merge(self, pieces: pa.Array) -> Ragged:
        """Ids of distinct pieces that are no tokens."""
        raw, out = _bytes_of(pieces), []
        # buckets of 1, 2, 3, 4, 6, 8, 12, 16 ... bytes; 0 for long pieces
        step = 1 << np.maximum(np.frexp(raw.count)[1] - 2, 0).astype(np.int64)
        bucket = np.where(raw.count > LONGEST, 0, -(-raw.count // step) * step)
        for width in np.unique(bucket).tolist():
            rows = np.flatnonzero(bucket == width)
            if width == 0:
                out += [(rows[i : i + 1], self._long(pieces[row].as_py())) for i, row in enumerate(rows.tolist())]
                continue
            most = max(1, CELLS // width)
            parts = [rows[at : at + most] for at in range(0, len(rows), most)]
            out += [(part, self.merge_rows(raw.take(part))) for part in parts]
        return _joined(out, len(pieces))

    def _long(self, piece: bytes) -> Ragged:
        ids = self.merge_long(piece)
        return Ragged(ids, np.array([len(ids)]))

    def ids_of(self, pieces: pa.Array) -> Ragged:
        """Ids of each of the distinct pieces, from those met lately where possible."""
        place = pc.index_in(pieces, value_set=self.known)
        new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        place = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[new] = len(self.known) + np.arange(len(new))
        unseen = pieces.take(pa.array(new))
        every = self.known_ids + self.merge(unseen)
        if len(every) <= len(self.tokens) + CACHED and self.known.nbytes + unseen.nbytes <= CACHED_BYTES:
            self.known, self.known_ids = pa.concat_arrays([self.known, unseen]), every
        else:  # begin anew with the pieces of this batch
            met = np.flatnonzero(place >= len(self.tokens))
            mine = pieces.take(pa.array(met))
            if len(mine) > CACHED or self.tokens.nbytes + mine.nbytes > CACHED_BYTES:
                met, mine = met[:0], mine[:0]
            self.known = pa.concat_arrays([self.tokens, mine])
            self.known_ids = self.token_ids + every.take(place[met])
        return Ragged(every.flat, every.count[place], every.start[place])

    def cut(self, text: str) -> list[str]:
        """Cut before single spaces between other characters, where every match of the pattern begins anew.

        The space belongs to the part after it and is left out: all parts but the first have it.
        """
        parts = text.split(" ")
        out = [parts[0]]
        for part in parts[1:]:
            # a space next to white space belongs to a longer run: leave it inside its part
            if part and not part[0].isspace() and out[-1] and not out[-1][-1].isspace():
                out.append(part)
            else:
                out[-1] = f"{out[-1]} {part}"
        return out

    def cut_all(self, texts: pa.Array) -> pa.Array:
        """The parts of each text: cut at every space if none is next to white space."""
        parts = pc.split_pattern(texts, " ")
        wide = pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False)
        if not wide.any():
            return parts
        cut = pa.array([self.cut(t) for t in texts.filter(pa.array(wide)).to_pylist()], parts.type)
        place = np.where(wide, len(parts) + wide.cumsum() - 1, np.arange(len(parts)))
        return pa.concat_arrays([parts, cut]).take(pa.array(place))

    def pieces_of(self, firsts: pa.Array, spaced: pa.Array) -> tuple[pa.Array, Ragged]:
        """The distinct pieces, and which of them make up each part: first ones, then those after a space."""
        plain = pc.invert(pc.or_(pc.match_substring_regex(spaced, _SPACE), pc.equal(spaced, "")))
        # after a line break in front of a single space matches begin anew, too, and the break is one by itself
        lines = spaced.filter(plain).to_pylist()
        found = pa.array(self.pattern.findall(" " + "\n ".join(lines)) if lines else [], pa.string())
        breaks = pc.equal(found, "\n")
        ends = np.append(np.flatnonzero(breaks.to_numpy(zero_copy_only=False)), len(found) if lines else [])
        lengths = np.diff(ends.astype(np.int64), prepend=-1) - 1
        rest = [*firsts.to_pylist(), *(f" {x}" for x in spaced.filter(pc.invert(plain)).to_pylist())]
        others = [self.pattern.findall(x) for x in rest]
        pieces = pa.concat_arrays([found.filter(pc.invert(breaks)), pa.array([p for f in others for p in f], pa.string())])
        numbered = pieces.dictionary_encode()
        counts = np.append(lengths, np.fromiter(map(len, others), np.int64, len(others)))
        is_plain = np.append(np.zeros(len(firsts), bool), plain.to_numpy(zero_copy_only=False))
        order = np.append(np.flatnonzero(is_plain), np.flatnonzero(~is_plain))
        start, count = np.empty_like(order), np.empty_like(order)
        start[order], count[order] = counts.cumsum() - counts, counts
        return numbered.dictionary, Ragged(numbered.indices.to_numpy(), count, start)

    def parts_of(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, Ragged]:
        """The distinct first parts and those after a space, and which of them make up each text."""
        parts = self.cut_all(texts.cast(pa.string()).fill_null(""))
        flat, count = parts.flatten(), pc.list_value_length(parts).to_numpy().astype(np.int64)
        first = np.zeros(len(flat), bool)
        first[count.cumsum() - count] = True
        firsts, spaced = (flat.filter(pa.array(x)).dictionary_encode() for x in (first, ~first))
        place = np.empty(len(flat), np.int64)
        place[first] = firsts.indices.to_numpy()
        place[~first] = spaced.indices.to_numpy().astype(np.int64) + len(firsts.dictionary)
        return firsts.dictionary, spaced.dictionary, Ragged(place, count)

    def encode_texts(self, texts: pa.Array) -> Iterator[Ragged]:
        """Ids of the texts, of ``ROWS`` texts at a time."""
        firsts, spaced, rows = self.parts_of(texts)
        pieces, of_part = self.pieces_of(firsts, spaced)
        ids = self.ids_of(pieces.cast(pa.binary())).of(of_part)
        del firsts, spaced, pieces, of_part
        for at in range(0, len(rows), ROWS):
            yield ids.of(rows.take(np.arange(at, min(at + ROWS, len(rows)))))

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text."""
        out = []
        for ids in self.encode_texts(pa.array(texts, pa.string())):
            out += [ids.flat[a : a + n].tolist() for a, n in zip(ids.start.tolist(), ids.count.tolist())]
        return out

    def spell(self, ids: Ragged, words: pa.Array, between: bytes) -> pa.Array:
        """For each row of ids its words in one."""
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(ids.start, len(ids.flat))), words.take(pa.array(ids.flat)))
        return pc.binary_join(lists, pa.scalar(between, words.type))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@contextmanager
def _vocabulary(name: str, pattern: str) -> Iterator[Vocabulary]:
    """The vocabulary for one task: a worker that Spark keeps for other work holds nothing of it."""
    collected = gc.isenabled()
    gc.disable()  # tuples by the million and no cycles: the collector only costs time
    try:
        yield Vocabulary(read_ranks(SparkFiles.get(name)), pattern)
    finally:
        if collected:
            gc.enable()


def ship(spark: SparkSession, path: str) -> str:
    """Send the rank file to every executor; its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _encoded(batches, vocabulary: Vocabulary) -> Iterator[tuple[pa.RecordBatch, Ragged]]:
    """Batches cut to ``ROWS`` rows, and the ids of the texts in their last column."""
    for batch in batches:
        at = 0
        for ids in vocabulary.encode_texts(batch.column(batch.num_columns - 1)):
            yield batch.slice(at, len(ids)), ids
            at += len(ids)


def encode(docs: DataFrame, path: str, pattern: str, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``docs``, the ``ids`` (array) of every whole text, and whether they decode to it (``intact``).

    The check is made by the worker that encodes: a second one would hold another vocabulary.
    """
    name = ship(docs.sparkSession, path)
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns]

    def run(batches):
        with _vocabulary(name, pattern) as vocabulary:
            for batch, ids in _encoded(batches, vocabulary):
                texts = batch.column(batch.num_columns - 1).cast(pa.large_binary()).fill_null(b"")
                intact = pc.equal(vocabulary.spell(ids, vocabulary.raw, b""), texts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(ids.start, len(ids.flat)), pa.int32()), pa.array(ids.flat))
                yield {c: batch.column(c) for c in columns} | {"ids": lists, "intact": intact}

    rows = docs.select(*columns, F.col(text).alias("__text"))
    return scan(rows, ", ".join([*kinds, "ids array<int>, intact boolean"]), run)


def decode(encoded: DataFrame, path: str, pattern: str, columns: list[str], ids: str = "ids") -> DataFrame:
    """``columns`` and the decoded ``raw`` bytes."""
    name = ship(encoded.sparkSession, path)
    kinds = [f"{c} {encoded.schema[c].dataType.simpleString()}" for c in columns]

    def run(batches):
        with _vocabulary(name, pattern) as vocabulary:
            for batch in batches:
                rest = {c: batch.column(c) for c in columns}
                yield rest | {"raw": [vocabulary.decode(x or []) for x in batch.column(batch.num_columns - 1).to_pylist()]}

    return scan(encoded.select(*columns, F.col(ids).alias("__ids")), ", ".join([*kinds, "raw binary"]), run)


def digest(docs: DataFrame, path: str, pattern: str, columns: list[str], text: str = "text") -> DataFrame:
    """``columns``, ``n_tokens``, and digests of the ids and of what they decode to."""
    name = ship(docs.sparkSession, path)
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns]

    def run(batches):
        with _vocabulary(name, pattern) as vocabulary:
            for batch, ids in _encoded(batches, vocabulary):
                out = {c: batch.column(c) for c in columns} | {"n_tokens": ids.count}
                for column, words, between in (("ids_sha256", vocabulary.decimal, b","), ("decoded_sha256", vocabulary.raw, b"")):
                    out[column] = [sha256(x).hexdigest() for x in vocabulary.spell(ids, words, between).to_pylist()]
                yield out

    rows = docs.select(*columns, F.col(text).alias("__text"))
    return scan(rows, ", ".join([*kinds, "n_tokens long, ids_sha256 string, decoded_sha256 string"]), run)
