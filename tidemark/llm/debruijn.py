"""Phrase collocations from a weighted de Bruijn graph of each language.

Nodes are runs of ``LONGEST - 1`` words, edges the runs of ``LONGEST`` words between
two overlapping nodes, weighted by how often they occur.

1. ``longest_grams``: one gram starts at every word, as long as the piece allows, at most
   ``LONGEST`` words. Full ones are edges; shorter ones stand at the end of a piece.
   They are counted in the workers first and then once more by node.
2. ``node_flow``: how often a node occurs is the flow along its edges plus its
   corrections, the grams that end with their piece in it. Shorter runs are the flow
   of the nodes that begin with them plus corrections in the same way. Nothing
   but grams is counted in the texts, single words and their sum apart.
3. ``compact``: a node with one frequent edge in and out is joined with its neighbours.
   Paths come out as whole word sequences (phrases of any length); every node and edge lies
   on exactly one path, and ``edges_of`` reads them back.
4. ``collocations``: cuts, scores and containment of the phrases read from the paths.

Grams are counted as numbers of words. A word that is rarer than ``least`` in its language cannot be
part of a phrase, so it has no number and a gram ends before it, as at the end of a piece. Workers know the
numbers where the frequent words fit into ``WORDS_BYTES``. Beyond that a word's number is a
64-bit digest, of rare words too; that no two words share one is checked over all words, and another
key is taken if they do. Results are the same. Equal grams are summed in the workers before they are shuffled.

Defined results: a NULL text is empty; a NULL language is ``und``; texts without words give
nothing; repeated rows count each; an empty table gives an empty result; other columns are ignored. A piece
of any length is read whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, scan, stored

# At least three words: a node has two or more.
LONGEST = 4
LEAST = 30
MOST = 2000
INSIDE = 80
SCALE = 2_000_000
# Entries that a worker counts before it hands them on, and bytes of frequent words it may know.
HELD = 3_000_000
WORDS_BYTES = 48 * 1024 * 1024

# Bytes: A-Z in lower case, the ends of pieces as line ends, tabs as blanks.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
FOLDED = bytes(b + 32 if 65 <= b <= 90 else 10 if b in PIECE_ENDS else 32 if b == 9 else b for b in range(256))


def pieces(text: str | None) -> list[list[bytes]]:
    """Words of each piece that has any. Only blanks and tabs part words."""
    found = (piece.split() for piece in text.encode().translate(FOLDED).split(b"\n")) if text else ()
    return [words for words in found if words]


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, c``: occurrences of each word."""

    def rows(counts: dict[str, Counter]) -> dict:
        flat = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
        return {"lang": [r[0] for r in flat], "word": [r[1] for r in flat], "c": [r[2] for r in flat]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for words in pieces(text):
                    counts[lang].update(words)
            if sum(map(len, counts.values())) > HELD // 8:
                yield rows(counts)
                counts.clear()
        yield rows(counts)

    counted = scan(_plain(docs), "lang string, word string, c long", run)
    return counted.groupBy("lang", "word").agg(F.sum("c").alias("c"))


def _digest(lang: bytes, word: bytes, key: int) -> int:
    raw = hashlib.blake2b(lang + b"\0" + word, digest_size=8, key=key.to_bytes(4, "little")).digest()
    return int.from_bytes(raw, "little", signed=True) or 1


class Numbers:
    """Numbers of words: from a table that is sent to the workers, or digests of which none is shared."""

    def __init__(self, words: DataFrame, least: int, words_bytes: int) -> None:
        spark = words.sparkSession
        frequent = words.where(F.col("c") >= least)
        size = frequent.agg(F.sum(F.octet_length("word") + 100)).first()[0] or 0
        self.table, self.key, self.most = None, 0, None
        if size <= words_bytes:
            rows = frequent.orderBy(F.desc("c"), "lang", "word").select("lang", "word").toPandas()
            rows["id"] = np.arange(1, len(rows) + 1)
            known: dict[str, dict[bytes, int]] = defaultdict(dict)
            for lang, word, number in rows.itertuples(index=False):
                known[lang][word.encode()] = number
            self.table, self.most = spark.sparkContext.broadcast(dict(known)), len(rows)
            self.words = spark.createDataFrame(rows, "lang string, word string, id long")
        else:
            while True:
                key = self.key
                numbered = scan(words.select("lang", "word", "c"), "lang string, word string, c long, id long", lambda it: _numbered(it, key))  # noqa: B023
                if numbered.groupBy("id").count().where("count > 1").isEmpty():
                    break
                self.key += 1
            self.words = stored(numbered.where(F.col("c") >= least).select("lang", "word", "id"), "phrase-numbers")

    def of(self):
        """What a worker calls for a function from language and words to their numbers; 0 for a word without one."""
        table, key = self.table, self.key

        def known():
            numbers = table.value

            def look(lang: str, words: list[bytes]) -> list[int]:
                own = numbers.get(lang)
                return [own.get(w, 0) for w in words] if own else [0] * len(words)

            return look

        def digests():
            seen: dict[tuple, int] = {}

            def digest(lang: str, words: list[bytes]) -> list[int]:
                if len(seen) > HELD:
                    seen.clear()
                raw = lang.encode()
                return [seen.get((raw, w)) or seen.setdefault((raw, w), _digest(raw, w, key)) for w in words]

            return digest

        return known if table is not None else digests


def _numbered(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[dict]:
    for batch in batches:
        out = {name: batch.column(name).to_pylist() for name in ("lang", "word", "c")}
        out["id"] = [_digest(lang.encode(), word.encode(), key) for lang, word in zip(out["lang"], out["word"], strict=True)]
        yield out


class Packing:
    """How the numbers of a gram's words lie in columns: three to a column if they are small, else one."""

    def __init__(self, numbers: Numbers, longest: int) -> None:
        self.longest = longest
        self.bits = 0 if numbers.most is None else max(1, numbers.most.bit_length())
        self.each = max(1, 63 // self.bits) if self.bits else 1
        self.columns = [f"p{i}" for i in range(-(-longest // self.each))]

    def pack(self, words: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for low in range(0, self.longest, self.each):
            part = words[low : low + self.each]
            packed = part[0]
            for i in range(1, self.each):
                packed = packed << self.bits | (part[i] if i < len(part) else 0)
            out.append(packed)
        return out

    def unpack(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        if self.each == 1:
            return columns
        mask, out = (1 << self.bits) - 1, []
        for i in range(self.longest):
            which, place = divmod(i, self.each)
            out.append(columns[which] >> (self.bits * (self.each - 1 - place)) & mask)
        return out

    def pair(self) -> list[Column]:
        """The first two words, as what grams are dealt by."""
        if self.each == 1:
            return [F.col(c) for c in self.columns[:2]]
        if self.each == 2:
            return [F.col(self.columns[0])]
        return [F.shiftright(F.col(self.columns[0]), self.bits * (self.each - 2))]


def longest_grams(docs: DataFrame, numbers: Numbers, longest: int = LONGEST) -> DataFrame:
    """``p0, ..., c``: the longest gram from each word on, of two words or more, packed; number 0 is no word."""
    packing = Packing(numbers, longest)
    number_of, names = numbers.of(), packing.columns

    def summed(held: list[int]) -> dict:
        line = np.array([*held, *[0] * longest], np.int64)
        words = [line[: len(held)]]
        for i in range(1, longest):
            words.append(np.where(words[-1] != 0, line[i : len(held) + i], 0))
        long = words[1] != 0
        packed = packing.pack([w[long] for w in words])
        order = np.lexsort(packed[::-1])
        packed = [p[order] for p in packed]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for p in packed:
            new[1:] |= p[1:] != p[:-1]
        first = np.flatnonzero(new)
        return {n: p[first] for n, p in zip(names, packed, strict=True)} | {"c": np.diff(np.append(first, len(order)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = number_of()
        held: list[int] = []
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for words in pieces(text):
                    held += number(lang, words)
                    held.append(0)
                if len(held) > HELD:
                    yield summed(held)
                    held = []
        yield summed(held)

    return scan(_plain(docs), ", ".join(f"{n} long" for n in [*names, "c"]), run)


def _length(gram: Column | str) -> Column:
    return F.length(gram) - F.length(F.replace(gram, F.lit(" "))) + 1


def node_flow(grams: DataFrame, numbers: Numbers, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, node, c, edges``: runs of two words up to ``longest - 1`` that occur ``least`` times or more.

    ``edges`` are the frequent continuations of a node of ``longest - 1`` words (next word, weight).
    Grams meet once, by their first two words, and are read in order: a node is the run of grams
    that begin with it, and occurs as often as its edges and the corrections among them
    say; so do the shorter runs that nodes begin with. A hot pair is a longer run, never held as a whole.
    """
    packing = Packing(numbers, longest)
    names = [f"w{i + 1}" for i in range(longest)]
    sizes = range(longest, 1, -1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Sums of the sorted grams that begin alike, for each length; the last of a batch waits for the next batch."""
        held: dict[int, tuple[tuple, int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            words = packing.unpack([batch.column(c).to_numpy() for c in packing.columns])
            counts = batch.column("c").to_numpy()
            new, ends = np.zeros(batch.num_rows, bool), {}
            new[0] = True
            for i, word in enumerate(words):
                new[1:] |= word[1:] != word[:-1]
                ends[i + 1] = np.flatnonzero(new)
            out = []
            for size in sizes:
                first = ends[size]
                total = np.add.reduceat(counts, first)
                if size in held:
                    key, before = held[size]
                    if key == tuple(int(w[0]) for w in words[:size]):
                        total[0] += before
                    elif before >= least:
                        out.append((key, size, before))
                held[size] = tuple(int(w[first[-1]]) for w in words[:size]), int(total[-1])
                for at in np.flatnonzero(total[:-1] >= least).tolist():
                    out.append((tuple(int(w[first[at]]) for w in words[:size]), size, int(total[at])))
            yield rows(out)
        yield rows([(key, size, n) for size, (key, n) in held.items() if n >= least])

    def rows(found: list[tuple]) -> dict:
        columns = {name: [key[i] if i < size else 0 for key, size, _ in found] for i, name in enumerate(names)}
        return columns | {"size": [size for _, size, _ in found], "c": [n for _, _, n in found]}

    dealt = grams.repartition(*packing.pair()).sortWithinPartitions(*packing.columns)
    found = scan(dealt, ", ".join(f"{n} long" for n in [*names, "size", "c"]), sums)
    found = stored(found, "phrase-flow")
    spelled = found
    for i, name in enumerate(names):  # a run that is shorter than its level ended there, and counts below
        spelled = spelled.where((F.col(name) != 0) | (F.col("size") <= i))
        word = numbers.words.select(F.col("id").alias(name), F.col("word").alias(f"word{i}"), *(["lang"] if not i else []))
        spelled = spelled.join(word, name, "inner" if not i else "left")
    node = F.concat_ws(" ", *[f"word{i}" for i in range(longest - 1)])
    spelled = stored(spelled.select("lang", node.alias("node"), F.col(f"word{longest - 1}").alias("word"), "c", "size"), "phrase-spelled")
    to = F.struct("word", "c")
    out_edges = spelled.where(F.col("size") == longest).groupBy("lang", "node").agg(F.collect_list(to).alias("edges"))
    nodes = spelled.where(F.col("size") < longest).select("lang", "node", "c").join(out_edges, ["lang", "node"], "left")
    nodes = stored(nodes.withColumn("edges", F.coalesce("edges", F.array().cast("array<struct<word:string,c:bigint>>"))), "phrase-nodes")
    discard(found, spelled)
    return nodes


def _chains(links: DataFrame) -> DataFrame:
    """``lang, node, head, place`` for links ``lang, node, next`` in which nobody follows or precedes two.

    Pointers to the predecessor double their reach each round; a ring is opened at its least node.
    """
    nodes = links.select("lang", "node").union(links.select("lang", F.col("next").alias("node"))).distinct()
    back = links.select("lang", F.col("next").alias("node"), F.col("node").alias("up"))
    place = F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")
    first = nodes.join(back, ["lang", "node"], "left").select("lang", "node", "up", place.alias("place"), F.least("node", "up").alias("low"))
    state = stored(first, "phrase-chains")
    open_, rounds, most = state.where("up is not null").count(), 0, state.count().bit_length() + 1
    while open_:
        ahead = state.select("lang", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("place").alias("place2"), F.col("low").alias("low2"))
        # a pointer at a head stays; others jump to where that node points
        joined = state.join(ahead, ["lang", "up"], "left")
        moved = joined.select(
            "lang",
            "node",
            F.when(F.col("up2").isNotNull(), F.col("up2")).otherwise(F.col("up")).alias("up"),
            F.when(F.col("up2").isNotNull(), F.col("place") + F.col("place2")).otherwise(F.col("place")).alias("place"),
            F.least("low", F.coalesce("low2", "low")).alias("low"),
        )
        new = stored(moved, "phrase-chains")
        discard(state)
        state = new
        rounds += 1
        done = state.select("lang", F.col("node").alias("up")).where(F.col("place") == 0)
        left = state.where("up is not null").join(done, ["lang", "up"], "left_anti")
        open_ = left.count()
        if open_ and rounds > most:  # only rings are left
            rings = left.where(F.col("node") == F.col("low")).select("lang", F.col("node").alias("next"))
            return _chains(stored(links.join(rings, ["lang", "next"], "left_anti").select("lang", "node", "next"), "phrase-links"))
    return state.select("lang", "node", F.coalesce("up", "node").alias("head"), "place")


def compact(nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, words, flows, weights, shared``: unary paths of the nodes of ``longest - 1`` words.

    ``words`` is the phrase a path spells; its i-th node occurs ``flows[i]`` times, and ``weights[i]`` is
    the edge to the next node of the path. An edge between two paths is a row of its own, with
    ``shared`` set and no flows.
    """
    full = nodes.where(_length("node") == longest - 1)
    edges = full.select("lang", "node", F.explode("edges").alias("e"))
    tail = F.regexp_replace("node", "^[^ ]+ ", "")
    edges = edges.select("lang", "node", F.concat_ws(" ", tail, "e.word").alias("next"), F.col("e.c").alias("weight"))
    ways_in = edges.groupBy("lang", F.col("next").alias("next")).agg(F.count("*").alias("ways_in"))
    ways_out = edges.groupBy("lang", "node").agg(F.count("*").alias("ways_out"))
    edges = stored(edges.join(ways_in, ["lang", "next"]).join(ways_out, ["lang", "node"]), "phrase-edges")
    unary = edges.where("ways_in = 1 and ways_out = 1").select("lang", "node", "next", "weight")
    chains = _chains(unary.select("lang", "node", "next"))
    # an edge that closes a ring leads to a head, or back to a node alone, and stays an edge between paths
    inner = unary.join(chains.where("place > 0").select("lang", F.col("node").alias("next")), ["lang", "next"], "left_semi")
    placed = full.join(chains, ["lang", "node"], "left").join(inner.select("lang", "node", "weight"), ["lang", "node"], "left")
    item = F.struct(F.coalesce("place", F.lit(0)).alias("place"), "node", "c", "weight")
    paths = placed.groupBy("lang", F.coalesce("head", "node").alias("head")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    last = F.transform(F.slice("items", 2, F.size("items")), lambda i: F.substring_index(i["node"], " ", -1))
    paths = paths.select(
        "lang",
        F.concat_ws(" ", F.col("head"), last).alias("words"),
        F.col("items.c").alias("flows"),
        F.filter("items.weight", lambda w: w.isNotNull()).alias("weights"),
        F.lit(False).alias("shared"),
    )
    between = edges.join(inner.select("lang", "node", "next"), ["lang", "node", "next"], "left_anti")
    empty = F.array().cast("array<bigint>")
    branch = between.select(
        "lang", F.concat_ws(" ", "node", F.substring_index("next", " ", -1)).alias("words"),
        empty.alias("flows"), F.array("weight").alias("weights"), F.lit(True).alias("shared"),
    )
    return paths.unionByName(branch)


def edges_of(paths: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, gram, c``: the nodes and edges that lie on the paths."""
    words = F.split("words", " ")

    def run(at: Column, size: int) -> Column:
        return F.concat_ws(" ", F.slice(words, at + 1, size))

    nodes = paths.where(~F.col("shared")).select("lang", F.transform("flows", lambda c, i: F.struct(run(i, longest - 1).alias("gram"), c.alias("c"))).alias("g"))
    edges = paths.select("lang", F.transform("weights", lambda c, i: F.struct(run(i, longest).alias("gram"), c.alias("c"))).alias("g"))
    return nodes.union(edges).select("lang", F.inline("g"))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, words_bytes: int = WORDS_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases of one to ``longest`` words with their counts, words of each language, and the compacted paths."""
    words = stored(word_counts(docs), "phrase-words")
    sums = words.groupBy("lang").agg(F.sum("c").alias("n"))
    numbers = Numbers(words, least, words_bytes)
    nodes = node_flow(longest_grams(docs, numbers, longest), numbers, least, longest)
    paths = stored(compact(nodes, longest), "phrase-paths")
    shorter = nodes.where(_length("node") < longest - 1).select("lang", F.col("node").alias("gram"), "c")
    single = words.where(F.col("c") >= least).select("lang", F.col("word").alias("gram"), "c")
    return single.union(shorter).union(edges_of(paths, longest)), sums, paths


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, inside: int = INSIDE, words_bytes: int = WORDS_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``most`` best phrases of two words or more of each language.

    Products go through decimals of 38 digits, so no count of 64 bits overflows them.
    """
    counts, sums, _ = phrase_counts(docs, least, longest, words_bytes)
    counts = stored(counts, "phrase-counts")
    phrases = counts.where(F.instr("gram", " ") > 0).withColumn("words", F.split("gram", " "))
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = phrases.select("lang", "gram", F.col("c").alias("a"), "words", cut)
    part = lambda low, size: F.concat_ws(" ", F.slice("words", low, size))
    cuts = cuts.select("lang", "gram", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("words")).alias("right"))
    known = counts.select("lang", F.col("gram").alias("left"), F.col("c").alias("l"))
    cuts = cuts.join(known, ["lang", "left"]).join(known.toDF("lang", "right", "r"), ["lang", "right"])
    wide = F.lit(SCALE).cast("decimal(7,0)") * F.col("a").cast("decimal(19,0)")
    total = F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")
    cuts = cuts.withColumn("score", F.call_function("div", wide, total).cast("long"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "gram", "a").agg(worst)
    # the runs inside each longer phrase
    size = F.size("words")
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(0), size - n), lambda at: F.concat_ws(" ", F.slice("words", at + 1, n))),
        )
    )
    longer = phrases.where(size > 2).select("lang", F.explode(F.array_distinct(runs)).alias("gram"), F.col("c").alias("around"))
    longer = longer.groupBy("lang", "gram").agg(F.max("around").alias("around"))
    kept = scored.join(longer, ["lang", "gram"], "left")
    share = lambda x, by: F.lit(by).cast("decimal(10,0)") * F.col(x).cast("decimal(19,0)")
    kept = kept.where(F.col("around").isNull() | (share("around", 100) < share("a", inside)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.col("gram").cast("binary"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(sums, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"
    )
