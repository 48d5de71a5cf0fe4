"""Sliced sequences and percentiles must equal the plain window results."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.percentiles import exact_percentiles
from tidemark.operators.sequences import KeySequence, ranks


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else (None if rng.random() < 0.3 else f"k{rng.randrange(40)}")
        at = None if rng.random() < 0.02 else rng.randrange(500)
        rows.append((i, key, at, None if rng.random() < 0.1 else rng.randrange(100)))
    return spark.createDataFrame(rows, "id long, k string, at long, v long").cache()


ADD_SMALL = dict(row_number="rn", lag={"pv": "v"}, lead={"nv": "v"}, prior_sum={"ps": "v"})


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


ADD = dict(
    row_number="rn",
    lag={"pv": "v", "pid": "id"}, lead={"nv": "v"},
    prior_sum={"ps": "v"}, prior_count={"pc": "v"}, last_known={"lk": "v"},
)


@pytest.mark.parametrize("keys,order", [(["k"], ["at", "id"]), (["k"], ["v", "at", "id"]), ([], ["-at", "id"])])
def test_sliced_equals_plain(skewed, keys, order):
    plain = KeySequence(skewed, keys, order, plain_bytes=1 << 60).add(**ADD)
    cut = KeySequence(skewed, keys, order, plain_bytes=0, rows_per_task=100, fan=4)
    assert cut.sliced
    assert _rows(cut.add(**ADD)) == _rows(plain)


@pytest.mark.parametrize("keys,order", [(["k"], ["at"]), (["k"], ["-v"]), ([], ["v", "at"])])
def test_ranks_with_ties(skewed, keys, order):
    plain = ranks(skewed, keys, order, "rk", "dr")
    cut = ranks(skewed, keys, order, "rk", "dr", plain_bytes=0, rows_per_task=20, fan=4)
    assert _rows(cut) == _rows(plain)


def slice_sizes(cut):
    return [r["count"] for r in cut.pieces.groupBy(*cut.keys, "_slice").count().collect()]


def test_ties_are_cut_along_the_next_column(spark):
    rows = spark.createDataFrame([(0 if i % 3 else i % 5, f"{i * 7919 % 1000:04d}", i) for i in range(1000)], "a int, t string, v long")
    cut = KeySequence(rows, [], ["a", "t"], plain_bytes=0, rows_per_task=40, fan=20)
    assert max(slice_sizes(cut)) < 250
    plain = KeySequence(rows, [], ["a", "t"])
    assert _rows(cut.add(**ADD_SMALL)) == _rows(plain.add(**ADD_SMALL))


@pytest.mark.parametrize("order", [["t", "v"], ["one", "t"], ["none", "v"], ["flag", "t"]])
def test_any_order_is_cut(spark, order):
    """One short text beside many that begin alike, and a first column that is one value, NULL, or nearly so."""
    rows = [("A", 1, None, True, -1)] + [(f"customer-with-a-long-name-{i:06d}", 1, None, i != 700, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "t string, one int, none date, flag boolean, v long").withColumn("k", F.lit("hot"))
    cut = KeySequence(df, ["k"], order, plain_bytes=0, rows_per_task=200, fan=40)
    sizes = slice_sizes(cut)
    assert len(sizes) >= 12 and max(sizes) < 600 and sum(sizes) == 4001
    plain = KeySequence(df, ["k"], order, plain_bytes=1 << 60)
    assert _rows(cut.add(**ADD_SMALL)) == _rows(plain.add(**ADD_SMALL))


def test_rows_equal_in_the_whole_order_are_cut_too(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), F.lit(5).alias("at"), (F.col("id") % 7).alias("v"), F.col("id"))
    cut = KeySequence(df, ["k"], ["at"], plain_bytes=0, rows_per_task=300, fan=40)
    assert max(slice_sizes(cut)) < 900
    got = cut.add(row_number="rn", prior_count={"c": "id"}, lag={"p": "id"}).collect()
    assert sorted(r.rn for r in got) == list(range(1, 3001)) and all(r.c == r.rn - 1 for r in got)
    assert len({r.p for r in got}) == 3000  # each row follows another one


def test_no_hot_key_falls_back_to_plain_window(skewed):
    cut = KeySequence(skewed, ["k"], ["at", "id"], plain_bytes=0, rows_per_task=10**6)
    assert not cut.sliced
    assert _rows(cut.add(row_number="rn")) == _rows(
        KeySequence(skewed, ["k"], ["at", "id"], plain_bytes=1 << 60).add(row_number="rn")
    )


def test_hot_key_gets_several_slices(skewed):
    cut = KeySequence(skewed, ["k"], ["at", "id"], plain_bytes=0, rows_per_task=100, fan=20)
    hot = cut.pieces.where(F.col("k") == "hot").groupBy("_slice").count().collect()
    assert len(hot) > 5
    # keys that fit a task are not stored
    assert cut.pieces.where("k = 'k1'").isEmpty()


@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles_both_ways(skewed, keys):
    ps = {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}
    df = skewed.withColumn("v", F.when(F.col("k") != "k3", F.col("v")))
    plain = exact_percentiles(df, keys, "v", ps)
    cut = exact_percentiles(df, keys, "v", ps, few_rows=40, bins=16)
    round_all = lambda d: d.select(*keys, *[F.round(p, 9).alias(p) for p in ps])
    assert _rows(round_all(cut)) == _rows(round_all(plain))


@pytest.mark.parametrize("shape", ["long tails", "ties", "clusters", "infinite", "one value"])
def test_percentiles_of_awkward_values(spark, shape):
    rng = random.Random(3)
    values = {
        "long tails": [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(900)],
        "ties": [float(rng.choice((0, 0, 0, 0, 7, 1e9))) for _ in range(900)],
        "clusters": [1 + i * 2**-52 for i in range(300)] + [0.0] + [1e18 + 128 * i for i in range(300)],
        "infinite": [float("inf"), float("-inf")] * 40 + [rng.gauss(0, 1) for _ in range(300)],
        "one value": [4.5] * 50,
    }[shape]
    rng.shuffle(values)
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)] + [(7, None)], "k int, v double")
    ps = {"p0": 0.0, "p31": 0.31, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    plain = exact_percentiles(df, ["k"], "v", ps, few_rows=10**6)
    cut = exact_percentiles(df, ["k"], "v", ps, few_rows=20, bins=128)
    near = lambda d: {r.k: [None if x is None else pytest.approx(x, rel=1e-12) for x in r[1:]] for r in d.collect()}
    assert {r.k: list(r[1:]) for r in plain.collect() if shape != "infinite"} == {k: v for k, v in near(cut).items() if shape != "infinite"}
    if shape == "infinite":  # between two infinite values there is no number to compare
        assert {r.k: (r.p0, r.p50, r.p100) for r in plain.collect()} == {r.k: (r.p0, r.p50, r.p100) for r in cut.collect()}
