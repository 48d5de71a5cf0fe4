"""Silver in parts, the gate before publishing, and loads that cost what they bring."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError
from tidemark.plans import medallion as md
from tidemark.plans.erasure import erase_everywhere
from tidemark.plans.medallion import Lake, read_silver, run_medallion
from tidemark.session import table
from tidemark.sinks.parts import PartTable, Pointer, upsert_rows

SF = "/root/testdata/sf0.001"
NAMES = ("orders", "lineitem", "customer")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def raw(spark, condition="true"):
    out = {n: table(spark, SF, n) for n in NAMES}
    out["orders"] = out["orders"].where(condition)
    out["lineitem"] = out["lineitem"].where(condition.replace("o_", "l_"))
    return out


def gold(spark, lake):
    return {n: rows(spark.read.parquet(lake.gold(n))) for n in ("fact_sales", "fact_revenue_monthly")}


def whole(spark, folder, frames):
    """Gold of one load that brings everything."""
    lake = Lake(folder, 16)
    run_medallion(spark, frames, lake, "2024-01-01")
    return gold(spark, lake)


def test_parts_are_linked_until_touched(spark, folder):
    t = PartTable(spark, f"{folder}/t", ["k"], parts=16, keep=2)
    t.write(spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    change = spark.createDataFrame([(7, "b"), (1000, "new"), (None, "no key")], "k long, v string")
    for _ in range(2):  # a replay of version 1 gives the same
        now = t.merge(change, upsert_rows(["k"]), version=1)
    first = t.manifest(0)
    assert {p for p in first.folders if first.folders[p] != now.folders[p]} == set(t.touched(change, 16))
    got = rows(t.read())
    assert len(got) == 202 and (7, "b") in got and (None, "no key") in got and (8, "a") in got
    assert t.read(0).count() == 200
    for i in range(5):
        t.merge(spark.createDataFrame([(i, f"x{i}")], "k long, v string"), upsert_rows(["k"]))
    assert len(t.versions()) == 3 and t.read().count() == 202
    assert {(i, f"x{i}") for i in range(5)} <= set(rows(t.read()))


def test_parts_grow_with_the_table(spark, folder):
    t = PartTable(spark, f"{folder}/t", ["k"], parts=2, part_bytes=200)
    t.write(spark.range(2000).select(F.col("id").alias("k")))
    t.merge(spark.range(2000, 2010).select(F.col("id").alias("k")), upsert_rows(["k"]))
    assert t.manifest().parts == 8 and t.read().count() == 2010
    assert PartTable(spark, f"{folder}/none", ["k"]).read() is None
    empty = PartTable(spark, f"{folder}/empty", ["k"])
    empty.write(spark.range(0).select(F.col("id").alias("k")))
    assert empty.read().columns == ["k"] and empty.read().count() == 0


def test_pointer_is_replaced_whole(spark, folder):
    pointer = Pointer(spark, f"{folder}/p.json")
    assert pointer.get() == {}
    pointer.set({"a": 1})
    pointer.set({"a": 2, "b": 1})
    assert pointer.get() == {"a": 2, "b": 1}


def test_a_bad_load_stops_and_readers_keep_the_old_version(spark, folder):
    lake = Lake(f"{folder}/lake", 8)
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 0"), lake, "2024-01-01")
    before, silver = gold(spark, lake), rows(read_silver(spark, lake, "orders"))
    bad = raw(spark, "o_orderkey % 2 = 1")
    bad["orders"] = bad["orders"].withColumn("o_custkey", F.when(F.col("o_orderkey") % 10 == 1, F.col("o_custkey")))
    with pytest.raises(QualityError, match="orders: .* rows are bad"):
        run_medallion(spark, bad, lake, "2024-01-02")
    assert gold(spark, lake) == before and rows(read_silver(spark, lake, "orders")) == silver
    assert md.quarantined(spark, lake, "orders").count() > 0
    # mended, the same load goes through; with a lower bar the bad one would
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 1"), lake, "2024-01-02")
    assert gold(spark, lake) == whole(spark, f"{folder}/whole", raw(spark))
    low = Lake(f"{folder}/low", 8)
    run_medallion(spark, bad, low, "2024-01-02", least_good=0.1)
    assert read_silver(spark, low, "orders").count() == bad["orders"].where("o_custkey is not null").count()


def test_an_empty_load_stops(spark, folder):
    with pytest.raises(QualityError, match="0 rows"):
        run_medallion(spark, raw(spark, "o_orderkey < 0"), Lake(folder), "2024-01-01")


def test_rows_without_a_key_go_to_quarantine_each(spark, folder):
    lake = Lake(folder, 4)
    frames = raw(spark)
    lost = frames["orders"].where("o_orderkey <= 8").withColumn("o_orderkey", F.lit(None).cast("long"))
    count = lost.count()
    frames["orders"] = frames["orders"].union(lost)
    run_medallion(spark, frames, lake, "2024-01-01", least_good=0.5)
    bad = md.quarantined(spark, lake, "orders")
    assert count > 1 and bad.count() == count and bad.where("array_contains(_errors, 'missing:o_orderkey')").count() == count
    assert read_silver(spark, lake, "orders").count() == table(spark, SF, "orders").count()


def test_a_small_load_rewrites_only_its_parts_and_months(spark, folder):
    lake = Lake(f"{folder}/lake", 64)
    run_medallion(spark, raw(spark), lake, "2024-01-01")
    silver = {n: lake.silver(spark, n).manifest() for n in NAMES}
    few = {n: df for n, df in raw(spark, "o_orderkey in (1, 2, 3)").items()}
    few["lineitem"] = few["lineitem"].withColumn("l_quantity", F.col("l_quantity") + 1)
    files = lambda: {r.f for r in spark.read.parquet(lake.gold("fact_sales")).select(F.input_file_name().alias("f")).collect()}
    old_files = files()
    months = run_medallion(spark, few, lake, "2024-01-02")
    dates = few["orders"].select(F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1)
    assert months == sorted({r[0] for r in dates.collect()})
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        now = lake.silver(spark, name).manifest()
        moved = {p for p in now.folders if silver[name].folders.get(p) != now.folders[p]}
        assert moved == set(lake.silver(spark, name).touched(few[name], 64)) and len(moved) <= 3
    # customers came again unchanged: their rows keep the version they had
    assert lake.silver(spark, "customer").read().where(f"{md.VERSION} > 0").count() == 0
    new_files = files() - old_files
    assert new_files and len({f.rsplit("/", 1)[0] for f in new_files}) == len(months)
    changed = raw(spark)
    changed["lineitem"] = changed["lineitem"].withColumn(
        "l_quantity", F.col("l_quantity") + F.when(F.col("l_orderkey").isin(1, 2, 3), 1).otherwise(0)
    )
    assert gold(spark, lake) == whole(spark, f"{folder}/whole", changed)


def test_changes_of_every_kind_reach_gold(spark, folder):
    """A moved date, a new segment, a late load, and a load taken back and landed again with fewer rows."""
    lake = Lake(f"{folder}/lake", 16)
    run_medallion(spark, raw(spark, "o_orderkey % 3 <> 0"), lake, "2024-01-01")
    last = raw(spark, "o_orderkey % 3 = 0 and o_orderkey < 3000")
    last["orders"] = last["orders"].union(
        table(spark, SF, "orders").where("o_orderkey in (1, 2)").withColumn("o_orderdate", F.expr("o_orderdate + interval 400 days"))
    )
    last["customer"] = last["customer"].withColumn("c_mktsegment", F.when(F.col("c_custkey") % 50 == 0, "OTHER").otherwise(F.col("c_mktsegment")))
    run_medallion(spark, last, lake, "2024-01-05")
    # a late load does not overwrite what a newer one said
    run_medallion(spark, raw(spark, "o_orderkey in (1, 2, 3, 4)"), lake, "2024-01-03")
    every = raw(spark)
    moved = F.when(F.col("o_orderkey").isin(1, 2), F.expr("o_orderdate + interval 400 days")).otherwise(F.col("o_orderdate"))
    every["orders"] = every["orders"].where("o_orderkey % 3 <> 0 or o_orderkey < 3000 or o_orderkey = 3").withColumn("o_orderdate", moved)
    every["lineitem"] = every["lineitem"].where("l_orderkey % 3 <> 0 or l_orderkey < 3000 or l_orderkey = 3")
    every["customer"] = last["customer"]
    assert gold(spark, lake) == whole(spark, f"{folder}/whole", every)
    # the load of the 5th once more, without the moved dates and with fewer orders: its old rows go
    less = raw(spark, "o_orderkey % 3 = 0 and o_orderkey < 1500")
    run_medallion(spark, less, lake, "2024-01-05")
    left = raw(spark, "o_orderkey % 3 <> 0 or o_orderkey < 1500")
    assert gold(spark, lake) == whole(spark, f"{folder}/less", left)


def test_a_run_that_stopped_before_gold_is_finished_by_the_next(spark, folder, monkeypatch):
    lake = Lake(f"{folder}/lake", 8)
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 0"), lake, "2024-01-01")
    with monkeypatch.context() as patch:
        patch.setattr(md, "to_gold", lambda *args, **kwargs: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run_medallion(spark, raw(spark, "o_orderkey % 2 = 1"), lake, "2024-01-02")
    run_medallion(spark, raw(spark, "o_orderkey in (1, 2)"), lake, "2024-01-03")
    assert gold(spark, lake) == whole(spark, f"{folder}/whole", raw(spark))


def test_erasure_rewrites_only_what_holds_the_subject(spark, folder):
    lake = Lake(f"{folder}/lake", 64)
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 0"), lake, "2024-01-01")
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 1"), lake, "2024-01-02")
    person = table(spark, SF, "orders").where("o_orderkey = 1").select("o_custkey")
    who = person.first()[0]
    orders = table(spark, SF, "orders").where(F.col("o_custkey") == who)
    report = {(r.layer, r.table): r for r in erase_everywhere(spark, lake, person).collect()}
    assert all(r.rows_left == 0 for r in report.values())
    assert report["silver", "customer"].parts_rewritten == 1
    assert 0 < report["silver", "orders"].parts_rewritten <= orders.count() == report["silver", "orders"].rows_erased
    months = orders.select(F.year("o_orderdate"), F.month("o_orderdate")).distinct().count()
    assert report["gold", "fact_sales"].parts_rewritten == months
    keep = {n: df for n, df in raw(spark).items()}
    keep["customer"] = keep["customer"].where(F.col("c_custkey") != who)
    keep["orders"] = keep["orders"].where(F.col("o_custkey") != who)
    assert gold(spark, lake) == whole(spark, f"{folder}/whole", keep)
    # nothing of the person is left in any file of the lake that names customers, old versions included
    for name, column in (("orders", "o_custkey"), ("customer", "c_custkey")):
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        for layer in ("bronze", "silver"):
            assert files.parquet(f"{lake.root}/{layer}/{name}").where(F.col(column) == who).isEmpty()
    # and loads go on
    run_medallion(spark, raw(spark, "o_orderkey = 5"), lake, "2024-01-03")


def stored_plans(monkeypatch):
    """Plans of what ``PartTable`` stores from now on."""
    plans, store = [], PartTable._store

    def seen(self, df, version, parts):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(self, df, version, parts)

    monkeypatch.setattr(PartTable, "_store", seen)
    return plans


def test_a_merge_shuffles_rows_once(spark, folder, monkeypatch):
    lake = Lake(f"{folder}/lake", 8)
    plans = stored_plans(monkeypatch)
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 0"), lake, "2024-01-01")
    run_medallion(spark, raw(spark, "o_orderkey % 2 = 1"), lake, "2024-01-02")
    assert len(plans) == 6 and all(text.count("Exchange ") == 1 for text in plans)
    assert gold(spark, lake) == whole(spark, f"{folder}/whole", raw(spark))


def test_erasure_shuffles_rows_once(spark, folder, monkeypatch):
    from tidemark.plans import erasure

    lake = Lake(f"{folder}/lake", 8)
    run_medallion(spark, raw(spark), lake, "2024-01-01")
    plans, gathered, replace = stored_plans(monkeypatch), [], erasure.replace_partitions

    def seen(df, path, parts, rebalance=True, **kwargs):
        gathered.append(rebalance)
        replace(df, path, parts, rebalance=rebalance, **kwargs)

    monkeypatch.setattr(erasure, "replace_partitions", seen)
    subjects = table(spark, SF, "customer").where("c_custkey % 10 = 0").select("c_custkey")
    report = erase_everywhere(spark, lake, subjects).collect()
    assert len(plans) == 3 and all(text.count("Exchange ") == 1 and "Join" not in text for text in plans)
    assert gathered == [False] * 3  # one load: one partition of each bronze table
    assert all(r.rows_left == 0 for r in report)
    customers = read_silver(spark, lake, "customer")
    assert rows(customers) == rows(table(spark, SF, "customer").where("c_custkey % 10 <> 0").select(customers.columns))


def test_months_of_customers_that_move_without_a_broadcast(spark, folder, monkeypatch):
    """Nothing small enough to broadcast: customers of both versions are compared by shuffles alone."""
    monkeypatch.setattr(md, "size_shuffles", lambda *_: None)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "7"}
    was = {name: spark.conf.get(name, None) for name in settings}

    def frames(days, segments):
        """One order with two lines per customer and day."""
        orders = [(c * 100 + d, c, "O", 10.0, f"1997-{d:02d}-05", "1-URGENT") for c in range(9) for d in days]
        lines = [(o[0], n, 1, 1, 2.0, 10.0, 0.1, 0.0, "N", "O", o[4]) for o in orders for n in (1, 2)]
        customers = [(c, f"C{c}", 1, 1.0, s) for c, s in segments.items()]
        named = {
            "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"),
            "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"),
            "customer": (customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        }
        out = {name: spark.createDataFrame(*told) for name, told in named.items()}
        out["orders"] = out["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
        return out

    def segment_of(month, customer):
        facts = spark.read.parquet(lake.gold("fact_sales")).where((F.col("month") == month) & (F.col("customer_id") == customer))
        return {r[0] for r in facts.select("customer_segment").collect()}

    number = lambda month: 1997 * 12 + month - 1
    lake, all_a = Lake(folder, 4), dict.fromkeys(range(9), "A")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert run_medallion(spark, frames([1, 2], all_a), lake, "2024-01-01") is None
        # days 1 and 2 change only by the segment, and one customer has lost theirs
        assert run_medallion(spark, frames([3], all_a | {4: "B", 6: None}), lake, "2024-01-02") == [number(m) for m in (1, 2, 3)]
        assert segment_of(1, 4) == {"B"} and segment_of(2, 6) == {None} and segment_of(3, 5) == {"A"}
        # the same again changes nothing
        assert run_medallion(spark, frames([1, 2], all_a), lake, "2024-01-01") == []
        # customer 5 is in neither load any more
        left = {c: s for c, s in all_a.items() if c != 5}
        assert run_medallion(spark, frames([3], left | {4: "B", 6: None}), lake, "2024-01-02") == []
        assert run_medallion(spark, frames([1, 2], left), lake, "2024-01-01") == [number(m) for m in (1, 2, 3)]
        assert segment_of(1, 5) == {None} and segment_of(3, 4) == {"B"}
    finally:
        for name, value in was.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
