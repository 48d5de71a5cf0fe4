"""Near-duplicate documents by b-bit MinHash.

1. Every whole text becomes its set of word shingles, as 64-bit hashes. Equal sets
   are one class; from here on a class stands for all its copies.
2. A class gets the minima of many hash functions. Four of them make a band; the
   number of bands is chosen so that a pair at the threshold meets in one of
   them but for a chance of ``MISSED``. Of each minimum ``BITS`` low bits are
   kept, packed into words.
3. Classes that share a band are candidates. The similarity is estimated from the
   number of equal low bits, corrected for those equal by chance; a pair is dropped only
   if the estimate is ``MARGIN`` standard deviations below the threshold.
4. Candidates are confirmed on their full sets. First each class with the least
   one of its bucket; links give components. Then, in buckets that still hold
   several components, all pairs across components whose estimate allows it,
   each pair in one bucket only and buckets in blocks of ``BLOCK`` classes, so that
   no link is lost and no pair within a component is looked at or emitted.
5. Components over the links give the result.

Sets are only built again for the classes that are candidates.

Defined results: a text that is NULL or has no word has an empty set and is
linked with nothing; fewer words than a shingle make one shingle of them all;
repeated rows are linked; a missing key is never the smallest unless there is no
other; rows of one key may have different texts, and each text is linked by itself;
an empty table gives an empty result.

A row is known by its key and a hash of its text, since neither a key nor its
absence tells one text from another. A class has a number of its own.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, discard, mix, prefix_hashes, scan, slice_hashes, stored
from tidemark.llm.components import connected

SHINGLE = 5
SIMILAR = 80
ROWS = 4
BITS = 4
MISSED = 1e-7
MARGIN = 4.5
BLOCK = 512
WIDTH = 1024
BROADCAST_IDS = 500_000

_RANDOM = np.random.default_rng(0xB17)
_ORDER = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(0, 2**31, (2, 1024), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDED = _RANDOM.integers(0, 2**32, 1024, dtype=np.uint32)
_NIBBLES = np.uint64(0x1111111111111111)


def shingle_set(raw: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    text = np.frombuffer(raw.lower(), np.uint8)  # of bytes, lower() changes A to Z only
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = (text != 32) & ((text < 9) | (text > 13))
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    words = slice_hashes(prefix_hashes(text), start, end)
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, np.uint64(n * int(BASE) % 2**64), np.uint64)
    for i in range(n):
        total += words[i : len(words) - n + 1 + i] * _ORDER[i]
    return np.unique(mix(total))


def bands_for(similar: int) -> int:
    """Bands so that a pair at the threshold is missed with a chance of MISSED at most; a multiple of 4."""
    meets = (similar / 100) ** ROWS
    return 4 * math.ceil(math.log(MISSED) / math.log1p(-meets) / 4) if meets < 1 else 4


def minima(shingles: np.ndarray, functions: int) -> np.ndarray:
    """Least value of each hash function over a set."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    first, second, added = (x[:functions, None] for x in (*_FACTORS, _ADDED))
    least = np.full(functions, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), WIDTH):
        x = values[None, at : at + WIDTH] * first
        x += added
        x ^= x >> np.uint32(15)
        x *= second
        x ^= x >> np.uint32(13)
        np.minimum(least, x.min(1), out=least)
    return least


def sketch(shingles: np.ndarray, bands: int) -> tuple[bytes, np.ndarray]:
    """Packed low bits of the minima, and a key for each band."""
    least = minima(shingles, bands * ROWS)
    low = (least & np.uint32(2**BITS - 1)).astype(np.uint8)
    packed = (low[0::2] | (low[1::2] << 4)).tobytes()
    parts = least.reshape(bands, ROWS).astype(np.uint64)
    keys = mix((parts * _ORDER[:ROWS]).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * BASE)
    return packed, keys.view(np.int64)


def estimates(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (words in the last axis), corrected for chance."""
    differ = one ^ other
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    hashes = one.shape[-1] * 64 // BITS
    equal = 1 - np.bitwise_count(differ & _NIBBLES).sum(-1) / hashes
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def least_estimate(similar: int, bands: int) -> float:
    s = similar / 100
    return s - MARGIN * math.sqrt(s * (1 - s) / (bands * ROWS)) / (1 - 2.0**-BITS)


def similar_sets(a: np.ndarray, b: np.ndarray, similar: int) -> bool:
    """100 * intersection >= similar * union, exactly."""
    if 100 * min(len(a), len(b)) < similar * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= similar * (len(both) - common)


def hash_of(text: str):
    return F.xxhash64(F.col(text).cast("binary"))


def _words(column) -> np.ndarray:
    """Fixed-width binary values as rows of 64-bit words."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1)


def sketches(docs: DataFrame, key: str, text: str, size: int, bands: int) -> DataFrame:
    """``key, hash, n`` and, unless the set is empty, ``f1, f2`` (its fingerprint), ``bits`` and ``bands``."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("raw"), hash_of(text).alias("hash"))

    def run(batches):
        for batch in batches:
            out = {name: [] for name in ("n", "f1", "f2", "bits", "bands")}
            for raw in batch.column(1).to_pylist():
                shingles = shingle_set(raw or b"", size)
                if len(shingles):
                    bits, keys = sketch(shingles, bands)
                    prints = [int(x.view(np.int64)) for x in _fingerprint(shingles)]
                    values = (len(shingles), *prints, bits, keys.tolist())
                else:
                    values = (0, None, None, None, None)
                for name, value in zip(out, values):
                    out[name].append(value)
            yield {"key": batch.column(0), "hash": batch.column(2), **out}

    return scan(rows, "key long, hash long, n long, f1 long, f2 long, bits binary, bands array<long>", run)


def _fingerprint(shingles: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return shingles.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(shingles * _ORDER[0]))


def _verify(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    with_b = pairs.join(sets.withColumnRenamed("cid", "b").withColumnRenamed("shingles", "set_b"), "b")
    with_a = with_b.join(sets.withColumnRenamed("cid", "a").withColumnRenamed("shingles", "set_a"), "a")

    def run(batches):
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            good = [(a, b) for a, b, x, y in rows if similar_sets(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similar)]
            if good:
                yield dict(zip("ab", map(list, zip(*good))))

    return scan(with_a.select("a", "b", "set_a", "set_b"), "a long, b long", run)


def _promising(pairs: DataFrame, least: float) -> DataFrame:
    """Drop pairs ``a, b, bits_a, bits_b`` that cannot be similar by their estimates."""

    def run(batches):
        for batch in batches:
            keep = np.flatnonzero(estimates(_words(batch.column(2)), _words(batch.column(3))) >= least)
            if len(keep):
                yield {"a": batch.column(0).take(keep), "b": batch.column(1).take(keep)}

    return scan(pairs.select("a", "b", "bits_a", "bits_b"), "a long, b long", run)


def _sets(docs: DataFrame, chosen: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``cid`` and the set of each class in ``chosen`` (``cid, least, f1, f2``), from the text of its row ``least``."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("raw"), hash_of(text).alias("hash"))
    chosen = chosen.select("cid", F.col("least.key").alias("least_key"), F.col("least.hash").alias("least_hash"), "f1", "f2")
    few = chosen.count() <= BROADCAST_IDS  # 40 bytes each
    same = F.col("key").eqNullSafe(F.col("least_key")) & (F.col("hash") == F.col("least_hash"))
    rows = rows.join(F.broadcast(chosen) if few else chosen, same)

    def run(batches):
        for batch in batches:
            out = {"cid": [], "shingles": []}
            for cid, raw, *want in zip(*(c.to_pylist() for c in batch.columns)):
                shingles = shingle_set(raw or b"", size)
                # other texts may share the hash: only those of the class count
                if len(shingles) and [int(x.view(np.int64)) for x in _fingerprint(shingles)] == want:
                    out["cid"].append(cid)
                    out["shingles"].append(shingles.tobytes())
            yield out

    sets = scan(rows.select("cid", "raw", "f1", "f2"), "cid long, shingles binary", run)
    return stored(sets.dropDuplicates(["cid"]), "shingle-sets")


def _across(buckets: DataFrame, similar: int, least: float) -> DataFrame:
    """Links between different labels within buckets: ``a, b``; rows ``band, cid, label, bits, bands, shingles``.

    A large bucket is cut into blocks of rows; every pair of blocks is a task of its own.
    """
    sizes = buckets.groupBy("band").agg(F.count("*").alias("rows"))
    cut = buckets.join(sizes, "band").withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda n: F.struct(F.least("block", n).alias("i"), F.greatest("block", n).alias("j")),
    )
    rows = cut.withColumn("pair", F.explode(other)).select("band", "pair.i", "pair.j", *IN_BUCKET)
    rows = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches):
        # most buckets hold two or three classes: they are told apart here, a group call each would cost more than its work
        task, held = None, []
        for batch in batches:
            found = []
            for band, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, i, j) != task:
                    if held:
                        found += links_across(*task, held, similar, least)
                    task, held = (band, i, j), []
                held.append(row)
            if found:
                yield dict(zip("ab", map(list, zip(*found))))
        if held and (found := links_across(*task, held, similar, least)):
            yield dict(zip("ab", map(list, zip(*found))))

    return scan(rows, "a long, b long", run)


IN_BUCKET = ("block", "cid", "label", "bits", "bands", "shingles")


def links_across(band: int, i: int, j: int, rows: list, similar: int, least: float) -> list[tuple[int, int]]:
    """Links between labels among ``rows`` (columns IN_BUCKET) that join labels not joined yet."""
    if len({r[2] for r in rows}) < 2:
        return []
    rows = sorted(rows, key=lambda r: r[1])
    block, cid, label = (np.array([r[c] for r in rows]) for c in range(3))
    bits = np.frombuffer(b"".join(r[3] for r in rows), np.uint64).reshape(len(rows), -1)
    bands = np.array([r[4] for r in rows])
    sets = [np.frombuffer(r[5], np.uint64) for r in rows]
    short = [(x >> np.uint64(48)).astype(np.uint16) for x in sets]
    lengths = np.array([len(x) for x in sets])
    every = np.arange(len(rows))
    seen = np.zeros(1 << 16, bool)
    group = {x: x for x in label.tolist()}

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = x = group[group[x]]
        return x

    found = []
    for x in range(len(rows) - 1):
        # in a pair of different blocks, pairs within one block belong to another task
        open_ = (every > x) & (label != label[x]) & ((i == j) | (block != block[x]))
        open_ &= 100 * np.minimum(lengths, lengths[x]) >= similar * np.maximum(lengths, lengths[x])
        others = np.flatnonzero(open_)
        if not len(others):
            continue
        guess = estimates(bits[others], bits[x])
        others, guess = others[guess >= least], guess[guess >= least]
        if not len(others):
            continue
        # a pair belongs to one of the bands that it shares
        n = bands.shape[1]
        turn = ((cid[others] ^ cid[x]).astype(np.uint64) % np.uint64(n)).astype(np.int64)
        order = np.where(bands[others] == bands[x], (np.arange(n) - turn[:, None]) % n, n)
        own = bands[x][order.argmin(1)] == band
        others, guess = others[own], guess[own]
        if not len(others):
            continue
        # short hashes in common are at least as many as shingles in common
        seen[short[x]] = True
        starts = lengths[others].cumsum() - lengths[others]
        most = np.add.reduceat(seen[np.concatenate([short[y] for y in others])].astype(np.int64), starts)
        seen[short[x]] = False
        near = 100 * most >= similar * (lengths[others] + lengths[x] - most)
        for y in others[near][np.argsort(-guess[near], kind="stable")].tolist():
            a, b = find(int(label[x])), find(int(label[y]))
            if a != b and similar_sets(sets[x], sets[y], similar):
                group[max(a, b)] = min(a, b)
                found.append((int(cid[x]), int(cid[y])))
    return found


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, similar: int = SIMILAR
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row; ``similar`` in percent."""
    found = components(docs, key, text, size, similar)
    kept = F.col("key").eqNullSafe(F.col("component_id"))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def components(docs: DataFrame, key: str, text: str, size: int, similar: int) -> DataFrame:
    """``key, hash, n, component_id, component_hash`` of every row: what it is known by, and the row that stays for it."""
    bands = bands_for(similar)
    least = least_estimate(similar, bands)
    every = stored(sketches(docs, key, text, size, bands), "minhash")
    prints = ["n", "f1", "f2"]
    row = F.struct(F.col("key").isNull().alias("unkeyed"), "key", "hash")  # the least of these has a key, if any has
    classes = every.where("n > 0").groupBy(*prints).agg(F.min(row).alias("least"), F.first("bits").alias("bits"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")
    banded = classes.select(F.explode("bands").alias("band"), "cid")
    leaders = banded.groupBy("band").agg(F.min("cid").alias("leader"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    leaders = stored(leaders, "minhash-buckets")
    members = stored(banded.join(leaders, "band"), "minhash-members")  # only buckets of two or more
    bits = classes.select("cid", "bits")
    stars = members.where(F.col("cid") != F.col("leader")).select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct()
    stars = stars.join(bits.select(F.col("cid").alias("b"), F.col("bits").alias("bits_b")), "b")
    stars = stars.join(bits.select(F.col("cid").alias("a"), F.col("bits").alias("bits_a")), "a")
    stars = stored(_promising(stars, least), "minhash-stars")
    # sets of all that share a bucket: by one row of each class
    wanted = stored(members.select("cid").distinct().join(classes.select("cid", "least", "f1", "f2"), "cid"), "minhash-wanted")
    sets = _sets(docs, wanted, key, text, size)
    links = stored(_verify(stars, sets, similar), "minhash-links")
    labels = connected(links)
    # buckets that hold more than one component
    labelled = members.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left")
    labelled = labelled.select("band", "cid", F.coalesce("label", "cid").alias("label"))
    mixed = labelled.groupBy("band").agg((F.min("label") != F.max("label")).alias("mixed")).where("mixed").select("band")
    rest = labelled.join(mixed, "band").join(classes.select("cid", "bits", "bands"), "cid").join(sets, "cid")
    more = stored(_across(rest, similar, least), "minhash-links")
    final = connected(links.union(more))
    found = classes.select("cid", "least", *prints).join(final.withColumnRenamed("node", "cid"), "cid", "left")
    found = found.select(*prints, "least", F.coalesce("label", "cid").alias("label"))
    smallest = found.groupBy("label").agg(F.min("least").alias("stays"))
    found = stored(found.select(*prints, "label").join(smallest, "label").drop("label"), "minhash-components")
    out = every.select("key", "hash", *prints).join(found, prints, "left")
    alone = F.col("n") == 0
    result = out.select(
        "key",
        "hash",
        "n",
        F.when(alone, F.col("key")).otherwise(F.col("stays.key")).alias("component_id"),
        F.when(alone, F.col("hash")).otherwise(F.col("stays.hash")).alias("component_hash"),
    )
    discard(classes, leaders, members, stars, wanted, sets, links, more)
    return result


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near-duplicates: of each component one row with the smallest key stays."""
    found = stored(components(docs, key, text, size, similar), "minhash-found")
    stays = F.col("key").eqNullSafe(F.col("component_id")) & (F.col("hash") == F.col("component_hash"))
    identity = F.col("key"), F.col("hash")
    gone = found.where(~stays).select(*identity).distinct()
    few = gone.count() <= BROADCAST_IDS
    # whatever its columns are called, a row is one column here
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    docs = docs.select(row, F.col(f"`{key}`").alias("own_key"), hash_of(text).alias("own_hash"))
    same = F.col("own_key").eqNullSafe(F.col("key")) & (F.col("own_hash") == F.col("hash"))
    left = docs.join(F.broadcast(gone) if few else gone, same, "left_anti")
    # rows repeated as they are cannot be told from the one that stays
    twice = found.where(stays & (F.col("n") > 0)).groupBy(*identity).count().where("count > 1").drop("count")
    twice = stored(twice, "minhash-repeated")
    n = twice.count()
    if not n:
        return left.select("row.*")
    twice = F.broadcast(twice) if n <= BROADCAST_IDS else twice
    again = left.join(twice, same, "left_semi").withColumn("own_text", F.col("row").getField(text))
    again = again.dropDuplicates(["own_key", "own_text"]).drop("own_text")
    return left.join(twice, same, "left_anti").union(again).select("row.*")
