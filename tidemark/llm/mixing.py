"""Mix documents of several, possibly overlapping sources to target weights.

1. Documents are aggregated by membership pattern, the set of sources that hold
   them. Sizes of patterns and sources are sums over all documents.
2. Targets: sources weigh ``WEIGHTS`` in turn, by code point, NULL last, and
   share the total; no target exceeds ``MOST_REPEATS`` times its source, the
   excess is shared again by weight.
3. A min-cost flow takes words of patterns to quotas of sources. The k-th
   repetition of a pattern has its own arc of the pattern's size, dearer than the
   one before it, so nothing is repeated while something fresh could fill the quota.
4. A pattern with a flow of r sizes and a rest gives every document floor(r)
   times; the rest goes to documents in the order of a seeded hash. The place
   where it is used up is found by histograms of the hash, ever finer around that
   place, then by rows; what is left is filled by the largest documents that fit.

The driver sees a row for each pattern (``MOST_PATTERNS`` at most, else an error) and histogram bins.

Defined results: a NULL text has size 0 and takes nothing; a NULL source is a
source of its own; repeated rows are documents of their own, but rows with the same key and
size are taken or left together; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import local_rows, n_words, stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BINS = 1024
LEVELS = 2
FILL_ROUNDS = 4
NEAR = 0.001
MOST_PATTERNS = 100_000


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Words wanted of each source."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [n for n in sizes if n is None]
    weight = {n: WEIGHTS[i % len(WEIGHTS)] for i, n in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        share = left / sum(weight[n] for n in open_)
        full = [n for n in open_ if share * weight[n] > MOST_REPEATS * sizes[n]]
        if not full:
            return out | {n: share * weight[n] for n in open_}
        for n in full:
            out[n] = float(MOST_REPEATS * sizes[n])
            left -= out[n]
        open_ = [n for n in open_ if n not in full]
    return out


def flow(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = MOST_REPEATS) -> list[dict]:
    """Words that each pattern ``(sources, size)`` gives to each source: a min-cost maximum flow.

    Successive shortest paths with potentials; the k-th repetition costs k * k.
    """
    names = list(quotas)
    first, n = len(patterns) + 1, len(patterns) + len(names) + 2
    place = {name: first + i for i, name in enumerate(names)}
    arcs: list[list] = []  # to, capacity left, cost; arc i ^ 1 is its reverse
    out: list[list[int]] = [[] for _ in range(n)]

    def arc(a: int, b: int, capacity: float, cost: float) -> None:
        out[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0.0, -cost])

    for i, (sources, size) in enumerate(patterns):
        for k in range(repeats):
            arc(0, i + 1, float(size), float(k * k))
        for source in sources:
            arc(i + 1, place[source], float("inf"), 0.0)
    for name in names:
        arc(place[name], n - 1, quotas[name], 0.0)
    potential, least = [0.0] * n, 1e-6
    while True:
        distance, via, heap = [float("inf")] * n, [-1] * n, [(0.0, 0)]
        distance[0] = 0.0
        while heap:
            d, a = heapq.heappop(heap)
            if d > distance[a]:
                continue
            for e in out[a]:
                b, capacity, cost = arcs[e]
                if capacity > least and (there := d + cost + potential[a] - potential[b]) < distance[b] - 1e-9:
                    distance[b], via[b] = there, e
                    heapq.heappush(heap, (there, b))
        if via[n - 1] < 0:
            break
        potential = [p + d if d < float("inf") else p for p, d in zip(potential, distance)]
        path, at = [], n - 1
        while at:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        amount = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= amount
            arcs[e ^ 1][1] += amount
    given = []
    for i in range(len(patterns)):
        given.append({names[arcs[e][0] - first]: arcs[e ^ 1][1] for e in out[i + 1] if e % 2 == 0})
    return given


def _boundaries(sizes: DataFrame, rest: dict[int, float]) -> dict[int, tuple[int, float]]:
    """For each pattern the place up to which its documents fit into ``rest``, and the words left then."""
    spark = sizes.sparkSession
    width = (1 << 32) // BINS
    state = {p: (0, r) for p, r in rest.items()}
    for _ in range(LEVELS if state else 0):
        bounds = local_rows(spark, [(p, low) for p, (low, _) in state.items()], "pattern long, low long")
        bin_ = F.floor((F.col("place") - F.col("low")) / width)
        inside = sizes.join(F.broadcast(bounds), "pattern").withColumn("bin", bin_).where((F.col("bin") >= 0) & (F.col("bin") < BINS))
        filled: dict[int, np.ndarray] = {}
        for row in inside.groupBy("pattern", "bin").agg(F.sum("size").alias("n")).collect():  # BINS rows a pattern at most
            filled.setdefault(row.pattern, np.zeros(BINS))[int(row.bin)] = row.n
        for p, (low, r) in state.items():
            upto = filled.get(p, np.zeros(BINS)).cumsum()
            first = int(np.searchsorted(upto, r, side="right"))  # the first bin that does not fit whole
            state[p] = (low + first * width, r - (float(upto[first - 1]) if first else 0.0))
        width //= BINS
    return state


@dataclass(frozen=True)
class Mix:
    """What decides how often a document is taken, all of it small tables by pattern."""

    patterns: DataFrame  # sources, pattern, times, low
    fill: DataFrame  # pattern, place, size, filled
    source_sizes: dict
    targets: dict

    def take(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with columns of ``sized``) and ``taken``, the words the mix takes of each."""
        # a NULL source must match too
        known = rows.join(F.broadcast(self.patterns.withColumnRenamed("sources", "s")), F.col("sources").eqNullSafe(F.col("s"))).drop("s")
        out = known.join(F.broadcast(self.fill), ["pattern", "place", "size"], "left")
        more = (F.col("place") < F.col("low")) | F.col("filled").isNotNull()
        times = F.least(F.col("times") + more.cast("long"), F.lit(MOST_REPEATS))
        return out.withColumn("taken", F.col("size") * times).drop("pattern", "times", "low", "filled")


def sized(docs: DataFrame, key: str, sources: Column, text: str, seed: int) -> DataFrame:
    """``docs`` with ``size``, ``sources`` and ``place`` (seeded hash below 2**32)."""
    rows = docs.withColumn("size", n_words(F.col(text))).withColumn("sources", sources)
    return rows.withColumn("place", F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("size")), F.lit(1 << 32)))


def plan(sizes: DataFrame) -> Mix:
    """Decide how to mix rows ``size, sources, place``, of which all are counted."""
    spark = sizes.sparkSession
    grouped = sizes.groupBy("sources").agg(F.sum("size").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(grouped) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} sets of sources")
    grouped.sort(key=lambda r: repr(list(r.sources)))
    source_sizes: dict[str | None, int] = {}
    for row in grouped:
        for source in set(row.sources):
            source_sizes[source] = source_sizes.get(source, 0) + row.n
    quota = targets_within(grouped, source_sizes)
    given = flow([(tuple(set(r.sources)), r.n) for r in grouped], quota)
    rows, rest = [], {}
    for i, (row, parts) in enumerate(zip(grouped, given)):
        wanted = min(float(MOST_REPEATS * row.n), sum(parts.values()))
        times = int(wanted // row.n) if row.n else 0
        rows.append((list(row.sources), i, times))
        rest[i] = wanted - times * row.n
    ddl = f"sources {sizes.schema['sources'].dataType.simpleString()}, pattern long, times long"
    named = F.broadcast(local_rows(spark, rows, ddl).withColumnRenamed("sources", "s"))
    marked = sizes.join(named, F.col("sources").eqNullSafe(F.col("s"))).select("pattern", "place", "size")
    state = _boundaries(marked, rest)
    bounds = local_rows(spark, [(*row, state[row[1]][0]) for row in rows], f"{ddl}, low long")
    # the documents that fill what is left: the largest that fits, a few times over; those of one place and size go together
    left = {p: r for p, (_, r) in state.items() if r >= max(1, NEAR * rest[p])}
    fill: list[tuple[int, int, int]] = []
    groups = marked.join(F.broadcast(bounds.select("pattern", "low")), "pattern").where("place >= low and size > 0")
    groups = groups.groupBy("pattern", "place", "size").agg(F.sum("size").alias("n"))
    for _ in range(FILL_ROUNDS):
        if not left:
            break
        room = F.broadcast(local_rows(spark, list(left.items()), "pattern long, room double"))
        chosen = F.broadcast(local_rows(spark, fill, "pattern long, place long, size long"))
        free = groups.join(chosen, ["pattern", "place", "size"], "left_anti").join(room, "pattern").where("n <= room")
        best = free.groupBy("pattern").agg(F.max(F.struct("n", "place", "size")).alias("b")).collect()  # a row for each pattern
        fill += [(r.pattern, r.b.place, r.b["size"]) for r in best]
        left = {r.pattern: left[r.pattern] - r.b.n for r in best if left[r.pattern] - r.b.n >= NEAR * rest[r.pattern]}
    filled = local_rows(spark, [(*x, True) for x in fill], "pattern long, place long, size long, filled boolean")
    return Mix(bounds, filled, source_sizes, quota)


def targets_within(grouped: list, source_sizes: dict) -> dict:
    """Targets that together ask for all documents once."""
    total, wanted = sum(r.n for r in grouped), targets(source_sizes)
    asked = sum(source_sizes.values())
    # overlapping sources count shared documents more than once: scale back to what there is
    return {s: t * total / asked for s, t in wanted.items()} if asked > total else wanted


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """``key, size, source_size, target, taken`` of every row, each with the one source it names."""
    sizes = sized(docs.select(key, source, text), key, F.array(source), text, seed)
    sizes = stored(sizes.select(key, "size", "sources", "place"), "mix-sizes")
    mixed = plan(sizes)
    rows = [(s, n, float(mixed.targets[s])) for s, n in mixed.source_sizes.items()]
    names = local_rows(docs.sparkSession, rows, f"source {docs.schema[source].dataType.simpleString()}, source_size long, target double")
    joined = mixed.take(sizes).join(F.broadcast(names), F.col("sources")[0].eqNullSafe(F.col("source")))
    return joined.select(key, "size", "source_size", "target", "taken")


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; those it does not take are gone."""
    columns = docs.columns
    named = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))
    at = {c: f"c{i}" for i, c in enumerate(columns)}
    rows = sized(named, at[key], F.array(at[source]), at[text], seed)
    mixed = plan(stored(rows.select("size", "sources", "place"), "mix-sizes"))
    taken = mixed.take(rows).where("taken > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))))
    return taken.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
