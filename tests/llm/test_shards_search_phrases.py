"""Shards of exact size, ranked search and phrases against plain Python on small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import balltree, debruijn, sharding
from tidemark.llm.common import prepare, table
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, shard string, slot long, score double, key string, row int"


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="module")
def odd(session):
    long = " ".join(f"w{i % 97} of the, kind" for i in range(4000))
    rows = [
        (1, None, "en", "x", 9, 0.5, "k", 1), (2, "", "en", None, None, None, None, None), (3, " \t.\n ", None, "x", 9, 0.5, "k", 1),
        (4, "One two. Three two one two", "en", "x", 9, 0.5, "k", 1), (5, "One two. Three two one two", "de", "x", 9, 0.5, "k", 1),
        (6, long, "en", "x", 9, 0.5, "k", 1), (6, long, "en", "x", 9, 0.5, "k", 1), (None, "no key, one two", "en", "x", 9, 0.5, "k", 1),
        (8, "aÉ漢 aÉ漢 " * 200, None, "x", 9, 0.5, "k", 1), (9, "ring ring " * 60 + "end", "en", "x", 9, 0.5, "k", 1),
    ]
    return session.createDataFrame(rows, DOCS)


# shards


def test_shards_have_exact_sizes_and_gapless_slots(session):
    docs = table(session, SMALL, "documents").repartition(7)
    rows = sharding.uniform_shards(docs, 16, cell_rows=5, block_rows=8).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())


def test_shard_query_tells_sizes_and_digests(session):
    rows = QUERIES["op11_shards"](session, SMALL).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in table(session, SMALL, "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None


def test_shards_of_odd_rows(session, odd):
    rows = sharding.uniform_shards(odd, 3).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [3, 3, 4]
    assert Counter(r.text for r in rows) == Counter(r.text for r in odd.collect())
    assert set(rows[0].asDict()) == set(odd.columns)
    again = sharding.uniform_shards(odd, 3).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sharding.uniform_shards(odd.limit(0), 3).collect() == []
    assert sharding.digest(odd.limit(0)).collect() == []
    assert len(sharding.digest(odd.limit(1)).collect()) == 1


def test_written_shards_keep_their_order(session, odd, folder):
    sharding.write_shards(sharding.uniform_shards(odd, 2), f"{folder}/shards")
    read = session.read.parquet(f"{folder}/shards")
    assert Counter(r.shard for r in read.collect()) == {0: 5, 1: 5}
    part = session.read.parquet(f"{folder}/shards/shard=0").collect()
    assert [r.slot for r in part] == sorted(r.slot for r in part)


def test_matrix_has_its_sums_and_moments():
    sizes, cells = np.array([5, 0, 9, 26]), np.array([10, 10, 10, 10])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    seen = []
    for seed in range(400):
        matrix = np.stack([sharding.Matrix(starts, cells, seed).row(b) for b in range(4)])
        assert (matrix.sum(0) == cells).all() and (matrix.sum(1) == sizes).all()
        seen.append(matrix[3, 0])
    # one entry is hypergeometric: 26 of 40 rows, 10 of them in the cell
    assert abs(np.mean(seen) - 6.5) < 0.3
    assert abs(np.var(seen) - 26 * 0.25 * 0.75 * 14 / 39) < 0.5


def test_draws_above_the_bound_of_numpy_follow_the_same_law():
    rng = np.random.default_rng(5)
    drawn = Counter(sharding._by_inversion(rng, 6, 9, 7) for _ in range(6000))
    for x in range(7):
        expected = 6000 * math.comb(6, x) * math.comb(9, 7 - x) / math.comb(15, 7)
        assert abs(drawn[x] - expected) < 5 * math.sqrt(expected) + 3
    large = [sharding._by_inversion(rng, 4 * 10**10, 6 * 10**10, 10**10) for _ in range(200)]
    deviation = math.sqrt(10**10 * 0.4 * 0.6 * 0.9)
    assert abs(np.mean(large) - 4 * 10**9) < 5 * deviation / math.sqrt(200)
    assert 0.8 < np.std(large) / deviation < 1.2
    counts = sharding.draw_counts(rng, np.array([10**9, 2 * 10**9, 5]), 10**9)
    assert counts.sum() == 10**9 and (counts >= 0).all()


def test_every_place_is_equally_likely(session):
    docs = session.range(40, numPartitions=3).select(F.col("id").alias("doc_id"))
    seen = Counter()
    for seed in range(30):
        for r in sharding.uniform_shards(docs, 2, seed=seed, cell_rows=7, block_rows=6).collect():
            seen[r.shard, r.slot // 5, r.doc_id // 10] += 1
    # 8 places of 5 slots, 4 tenths of documents: 37.5 expected in each of 32 boxes
    chi = sum((seen[s, p, d] - 37.5) ** 2 / 37.5 for s in range(2) for p in range(4) for d in range(4))
    assert chi < 70


# search


def brute_search(docs, items, k=10):
    rx = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    counted = [(i, Counter(rx.findall(lower(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 25 + (75 * c.total() * n_docs) // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in rx.findall(lower(text))
                if t in c
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_search_equals_brute_force(session, monkeypatch):
    docs, items = table(session, SMALL, "documents"), table(session, SMALL, "benchmark")
    expected = brute_search([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert found(QUERIES["op12_search"](session, SMALL)) == expected
    # several blocks of queries and small trees
    monkeypatch.setattr(balltree, "QUERY_BYTES", 2000)
    scored = session.sparkContext.accumulator(0)
    assert found(balltree.rank_documents(docs, items, counts=scored)) == expected
    assert scored.value > 0


def test_search_of_odd_rows(session, odd):
    items = session.createDataFrame(
        [(1, "one two one", "z"), (2, None, "z"), (3, "", "z"), (4, "zzz nothing", "z"), (None, "aÉ漢 end", "z"), (1, "KIND of w5", "z")],
        "item_id long, text string, doc_id string",
    )
    asked = [(r.item_id, r.text) for r in items.collect()]
    plain = [(r.doc_id, r.text) for r in odd.collect()]
    for k in (1, 3, 10):
        assert found(balltree.rank_documents(odd, items, k)) == brute_search(plain, asked, k)
    assert found(balltree.rank_documents(odd.limit(0), items)) == []
    assert found(balltree.rank_documents(odd, items.limit(0))) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    rows, dims = 600, 60
    near = rng.integers(0, 12, rows)  # twelve groups of near copies
    base = (rng.random((12, dims)) < 0.15) * rng.integers(10**6, 10**10, (12, dims))
    dense = base[near] + (rng.random((rows, dims)) < 0.02) * rng.integers(1, 10**7, (rows, dims))
    dense[:, 0] += 1
    starts = np.concatenate([[0], np.cumsum((dense > 0).sum(1))])
    vectors = balltree.Sparse(starts, np.nonzero(dense)[1], dense[dense > 0])
    tree = balltree.Tree(vectors, dims)
    queries = []
    for _ in range(20):
        index = np.unique(rng.integers(0, dims, 6))
        queries.append((index, rng.integers(1, 3, len(index))))
    bounds = tree.bounds(queries, dims)
    everything = 0
    for q, (index, count) in enumerate(queries):
        exact = dense[:, index] @ count
        for node, (low, high) in enumerate(tree.span):
            assert exact[tree.order[low:high]].max() <= bounds[node, q]
        keys = np.arange(rows)
        got, scored = balltree.search(tree, keys[tree.order], [(index, count)], bounds[:, [q]], [1], 5, dims)
        best = sorted((-s, i) for i, s in enumerate(exact.tolist()) if s > 0)[:5]
        assert sorted((-s, i) for _, i, s in got) == best
        everything += scored
    assert everything < 0.5 * rows * len(queries)


# phrases


def brute_phrases(docs, least, most=2000, longest=4):
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    counts, sums = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            sums[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + n]
            for p, a in frequent.items()
            for n in range(2, len(p))
            for i in range(len(p) - n + 1)
            if 100 * a >= 80 * own[p[i : i + n]]
        }
        rows = []
        for p, a in frequent.items():
            if p not in inside:
                score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), a, left, right))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(rows)[:most]):
            out.append((lang, rank + 1, phrase.decode(), a, left, right, sums[lang], -score))
    return sorted(out)


def test_phrases_equal_brute_force(session):
    docs = table(session, SMALL, "documents")
    plain = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(map(tuple, QUERIES["op13_phrases"](session, SMALL).collect())) == brute_phrases(plain, 30)
    for least, words_bytes in ((4, debruijn.WORDS_BYTES), (4, 0)):
        got = debruijn.collocations(docs, least, words_bytes=words_bytes)
        assert sorted(map(tuple, got.collect())) == brute_phrases(plain, least)


def test_phrases_of_odd_rows(session, odd, monkeypatch):
    monkeypatch.setattr(debruijn, "HELD", 400)
    plain = [(r.lang, r.text) for r in odd.collect()]
    for least, longest in ((2, 4), (30, 3), (2, 5)):
        got = debruijn.collocations(odd, least, longest)
        assert sorted(map(tuple, got.collect())) == brute_phrases(plain, least, longest=longest)
    assert debruijn.collocations(odd.limit(0)).collect() == []
    assert len(debruijn.collocations(odd, 2, most=3).where("lang = 'en'").collect()) == 3


def test_paths_spell_whole_phrases_and_keep_every_count(session):
    told = "a long line that many pages share word for word"
    rows = [(f"{told}, x",)] * 5 + [("page share word for another",)] * 5 + [("go round go round go round go round go round",)] * 3
    docs = session.createDataFrame(rows, "text string").withColumn("lang", F.lit("en"))
    counts, sums, paths = debruijn.phrase_counts(docs, 5)
    spelled = {r.words for r in paths.where("not shared").collect()}
    assert any(told.startswith(s) and len(s.split()) > 6 for s in spelled)
    got = {r.gram: r.c for r in counts.collect()}
    own = Counter()
    for (text,) in rows:
        for piece in text.split(","):
            words = piece.split()
            own.update(" ".join(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    assert got == {p: c for p, c in own.items() if c >= 5}
    assert counts.count() == len(got)
    assert sums.first().n == sum(c for p, c in own.items() if " " not in p)


def test_chains_open_rings(session):
    links = [("en", "a", "b"), ("en", "b", "c"), ("en", "r", "s"), ("en", "s", "t"), ("en", "t", "r"), ("en", "self", "self"), ("de", "a", "b")]
    links += [("fr", f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)]
    rows = debruijn._chains(session.createDataFrame(links, "lang string, node string, next string")).collect()
    placed = {(r.lang, r.node): (r.head, r.place) for r in rows}
    assert placed["en", "c"] == ("a", 2) and placed["de", "b"] == ("a", 1)
    assert [placed["en", x] for x in "rst"] == [("r", 0), ("r", 1), ("r", 2)]
    assert placed["fr", "n040"] == ("n000", 40)
