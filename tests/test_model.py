"""Change data, history and point-in-time lookups."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.change_data import (
    as_of,
    cdc_apply,
    erase,
    scd1,
    scd2,
    scd2_apply,
    scd2_close_and_insert,
    surrogate_key,
    upsert,
)
from tidemark.operators.cleanse import first_per_key, impute, iqr_outliers, zscore_outliers
from tidemark.operators.features import bucket_by_edges, duration_regression, growth_alert, ntile, ratio_to_total
from tidemark.operators.joins import enrich, orphans, point_in_time

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def changes(spark, data):
    return spark.createDataFrame(data, "k string, at date, seq int, v string")


CASES = [
    ("a", D(2024, 1, 1), 1, "x"),
    ("a", D(2024, 1, 5), 2, "x"),  # repeats the value
    ("a", D(2024, 2, 1), 3, "y"),
    ("a", D(2024, 2, 1), 4, "z"),  # same day, later sequence wins
    ("b", D(2024, 3, 1), 9, None),
    ("b", D(2024, 1, 1), 8, "p"),  # out of order
    ("c", D(2024, 1, 1), 1, None),
    ("c", D(2024, 1, 2), 2, "q"),  # NULL to a value
]


def test_scd2_intervals(spark):
    got = rows(scd2(changes(spark, CASES), "k", "at", "seq", ["v"]))
    assert got == sorted(
        [
            ("a", "x", D(2024, 1, 1), D(2024, 2, 1), False),
            ("a", "z", D(2024, 2, 1), None, True),
            ("b", "p", D(2024, 1, 1), D(2024, 3, 1), False),
            ("b", None, D(2024, 3, 1), None, True),
            ("c", None, D(2024, 1, 1), D(2024, 1, 2), False),
            ("c", "q", D(2024, 1, 2), None, True),
        ],
        key=str,
    )


@pytest.fixture(scope="module")
def feed(spark):
    rng = random.Random(3)
    data = [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", D(2024, 1, 1) + dt.timedelta(rng.randrange(300)), i, rng.choice("xyz"))
        for i in range(1500)
    ]
    return changes(spark, data).cache()


def test_scd2_invariants_and_slices(spark, feed):
    plain = scd2(feed, "k", "at", "seq", ["v"])
    cut = scd2(feed, "k", "at", "seq", ["v"], plain_bytes=0, rows_per_task=40, fan=4)
    assert rows(cut) == rows(plain)
    history = sorted(map(tuple, plain.collect()), key=lambda r: (r[0], r[2]))
    for _, group in itertools.groupby(history, key=lambda r: r[0]):
        group = list(group)
        assert sum(r[4] for r in group) == 1 and group[-1][3] is None
        for left, right in zip(group, group[1:]):
            assert left[3] == right[2] and left[2] < left[3] and left[1] != right[1]


def test_scd2_rebuild_of_touched_keys(spark, feed):
    early, late = feed.where("at < '2024-06-01'"), feed.where("k in ('k1', 'k2', 'hot')")
    before = scd2(early.unionByName(feed.where("k not in ('k1', 'k2', 'hot') and at >= '2024-06-01'")), "k", "at", "seq", ["v"])
    rebuilt = scd2_apply(before, scd2(late, "k", "at", "seq", ["v"]), "k")
    assert rows(rebuilt) == rows(scd2(feed, "k", "at", "seq", ["v"]))
    again = scd2_apply(rebuilt, scd2(late, "k", "at", "seq", ["v"]), "k")
    assert rows(again) == rows(rebuilt)


def test_scd2_close_and_insert_equals_full_history(spark):
    log = [("a", D(2024, 1, 1), 1, "x"), ("b", D(2024, 1, 1), 2, "p")]
    daily = [
        [("a", D(2024, 1, 2), 3, "y"), ("c", D(2024, 1, 2), 4, "n")],
        [("a", D(2024, 1, 3), 5, "y"), ("b", D(2024, 1, 3), 6, None)],
        [("b", D(2024, 1, 4), 7, "p")],
    ]
    dimension = scd2(changes(spark, log), "k", "at", "seq", ["v"])
    for day in daily:
        dimension = scd2_close_and_insert(dimension, changes(spark, day), "k", "at", ["v"])
        log = log + day
        assert rows(dimension) == rows(scd2(changes(spark, log), "k", "at", "seq", ["v"]))


def test_point_in_time_equals_range_join(spark, feed):
    history = scd2(feed, "k", "at", "seq", ["v"]).cache()
    closed = history.where("not (k = 'k3' and is_current)")
    rng = random.Random(5)
    facts = spark.createDataFrame(
        [(i, rng.choice(["hot", "k1", "k3", "zz", None]), D(2023, 12, 20) + dt.timedelta(rng.randrange(320))) for i in range(400)],
        "id int, k string, on date",
    )
    h = closed.withColumnRenamed("k", "hk")
    holds = (F.col("k") == F.col("hk")) & (F.col("valid_from") <= F.col("on"))
    holds = holds & (F.col("valid_to").isNull() | (F.col("on") < F.col("valid_to")))
    want = rows(facts.join(h, holds, "left").select("id", "k", "on", "v"))
    assert rows(point_in_time(facts, closed, "k", "on", ["v"])) == want
    assert rows(point_in_time(facts, closed, "k", "on", ["v"], plain_bytes=0, rows_per_task=30, fan=4)) == want


def test_as_of_is_half_open(spark):
    history = scd2(changes(spark, CASES), "k", "at", "seq", ["v"])
    pick = lambda day: {(r["k"], r["v"]) for r in as_of(history, F.lit(day).cast("date")).collect()}
    assert pick("2024-01-31") == {("a", "x"), ("b", "p"), ("c", "q")}
    assert pick("2024-02-01") == {("a", "z"), ("b", "p"), ("c", "q")}
    assert pick("2023-12-31") == set()


def test_surrogate_keys_are_stable_and_distinct(spark):
    history = scd2(changes(spark, CASES), "k", "at", "seq", ["v"]).withColumn("sk", surrogate_key("k", "valid_from"))
    keys = [r["sk"] for r in history.collect()]
    assert len(set(keys)) == len(keys) == 6
    assert keys == [r["sk"] for r in history.collect()]


def test_upsert_is_idempotent_and_fills_missing_columns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    source = spark.createDataFrame([(2, "B", 5), (3, "C", 6)], "id int, x string, y int")
    once = upsert(target, source, ["id"])
    assert rows(once) == [(1, "a", None), (2, "B", 5), (3, "C", 6)]
    assert rows(upsert(once, source, ["id"])) == rows(once)


def test_cdc_delete_then_insert_revives(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = spark.createDataFrame(
        [(1, "x", "D", 1), (1, "y", "I", 2), (2, "q", "U", 1), (2, None, "D", 2), (4, "n", "I", 1), (5, "m", "I", 1), (5, None, "D", 3)],
        "id int, v string, op string, seq int",
    )
    assert rows(cdc_apply(target, log, ["id"], ["seq"])) == [(1, "y"), (3, "c"), (4, "n")]


def test_scd1_and_erase(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    log = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, v string, seq int")
    assert rows(scd1(dim, log, "id", ["seq"])) == [(1, "a"), (2, "y"), (3, "z")]
    people = spark.createDataFrame([(2,)], "person int")
    assert rows(erase(dim, people, "id", "person")) == [(1, "a")]


def test_first_per_key_is_idempotent(spark, feed):
    order = ["at", "seq"]
    once = first_per_key(feed, ["k", "at"], order)
    assert rows(first_per_key(once, ["k", "at"], order)) == rows(once)
    assert once.count() == feed.select("k", "at").distinct().count()


def test_imputation_and_outliers(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), ("c", 10.0)], "g string, v double"
    )
    assert rows(impute(df, "v", ["g"])) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 14 / 3), ("c", 10.0)]
    assert ("b", 3.0) in rows(impute(df, "v", ["g"], "median"))
    assert rows(impute(df, "v", ["g"], "median", few_rows=1, bins=2)) == rows(impute(df, "v", ["g"], "median"))
    spread = spark.createDataFrame([(float(i % 10),) for i in range(100)] + [(500.0,), (None,)], "v double")
    flagged = [r["v"] for r in zscore_outliers(spread, "v").where("is_outlier").collect()]
    assert flagged == [500.0]
    assert [r["v"] for r in iqr_outliers(spread, "v").where("is_outlier").collect()] == [500.0]
    same = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert zscore_outliers(same, "v").where("is_outlier").isEmpty()


def test_features(spark, feed):
    df = feed.select("k", "seq")
    sliced = ntile(df, ["k"], ["seq"], 7, "t", plain_bytes=0, rows_per_task=50, fan=4)
    assert rows(sliced) == rows(ntile(df, ["k"], ["seq"], 7, "t"))
    few = spark.createDataFrame([(i,) for i in range(3)], "n int")
    assert [r["t"] for r in ntile(few, [], ["n"], 5, "t", plain_bytes=0, rows_per_task=1, fan=2).orderBy("n").collect()] == [1, 2, 3]
    bands = spark.createDataFrame([(5.0,), (10.0,), (None,), (99.0,)], "v double")
    got = [r["b"] for r in bands.select(bucket_by_edges(F.col("v"), [10], ["low", "high"]).alias("b")).collect()]
    assert got == ["low", "high", None, "high"]
    shares = spark.createDataFrame([("a", 1), ("a", 3), ("z", 0), (None, 2)], "k string, v int")
    assert rows(ratio_to_total(shares, ["k"], "v", "r")) == sorted(
        [("a", 1, 0.25), ("a", 3, 0.75), ("z", 0, None), (None, 2, 1.0)], key=str
    )
    months = spark.createDataFrame([("a", 1, 100), ("a", 2, 111), ("a", 3, 111), ("b", 1, 5)], "k string, m int, n int")
    assert [r["m"] for r in growth_alert(months, ["k"], "m", "n").where("is_alert").collect()] == [2]
    jobs = spark.createDataFrame([("j", 1, 10), ("j", 2, 10), ("j", 3, 20), ("j", 4, 13)], "k string, t int, d int")
    assert [r["t"] for r in duration_regression(jobs, ["k"], ["t"], "d").where("is_regression").collect()] == [3]


def test_enrichment_and_orphans(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, code string")
    names = spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "code string, name string")
    assert rows(enrich(facts, names, {"code": "code"}, ["name"])) == [
        (1, "a", "Alpha"), (2, "x", "UNKNOWN"), (3, None, "UNKNOWN"),
    ]
    assert rows(orphans(facts, names, "code", "code")) == [(2, "x")]
