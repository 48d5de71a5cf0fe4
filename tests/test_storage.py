"""Batch sinks, layouts and readers."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.medallion import Lake, backfill, run_medallion
from tidemark.session import table, unique_name
from tidemark.sinks import batch, paths
from tidemark.sinks.parts import PartTable
from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sources import paged
from tidemark.sources.readers import HighWaterMark, jdbc_options, read_files

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshots_replay_and_prune(spark, folder):
    t = SnapshotTable(spark, f"{folder}/t", keep=2)
    assert t.read() is None
    for n in range(5):
        t.write(spark.createDataFrame([(n,)], "n int"), n)
    t.write(spark.createDataFrame([(44,)], "n int"), 4)
    assert rows(t.read()) == [(44,)] and rows(t.read(before=4)) == [(3,)]
    assert t.versions() == [2, 3, 4]


def test_unfinished_version_is_not_read(spark, folder):
    t = SnapshotTable(spark, f"{folder}/t")
    t.write(spark.createDataFrame([(1,)], "n int"), 0)
    paths.write_once(spark, f"{folder}/t/v=1/part-0.parquet", "half")
    assert rows(t.read()) == [(1,)]


def test_merge_twice_is_once(spark, folder):
    t = SnapshotTable(spark, f"{folder}/t")
    t.merge(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], 0)
    for _ in range(2):
        t.merge(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"], 1)
    assert rows(t.read()) == [(1, "a"), (2, "c"), (3, "d")]


def test_schema_enforcement(spark, folder):
    batch.append_enforced(spark.createDataFrame([(1, "a")], "k int, v string"), f"{folder}/p")
    other = spark.createDataFrame([("x", 1)], "k string, w int")
    with pytest.raises(batch.SchemaMismatch, match="k: mistyped.*v: missing.*w: extra"):
        batch.append_enforced(other, f"{folder}/p")
    wider = spark.createDataFrame([(2, "b", 3)], "k int, v string, w int")
    batch.append_enforced(wider, f"{folder}/p", merge_schema=True)
    assert rows(spark.read.option("mergeSchema", True).parquet(f"{folder}/p")) == [(1, "a", None), (2, "b", 3)]


def test_landing_a_day_again_replaces_it(spark, folder):
    for n in (3, 5):
        batch.land(spark.range(n), f"{folder}/b", "2024-04-01", "erp")
    batch.land(spark.range(2), f"{folder}/b", "2024-04-02", "erp")
    batch.land(spark.range(4), f"{folder}/b", "2024-04-02", "crm")
    got = spark.read.parquet(f"{folder}/b").groupBy(F.col("load_date").cast("string"), "source_system").count()
    assert rows(got) == [("2024-04-01", "erp", 5), ("2024-04-02", "crm", 4), ("2024-04-02", "erp", 2)]


def test_retention_drops_whole_partitions(spark, folder):
    df = spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) as load_date from range(100)")
    batch.replace_partitions(df, f"{folder}/r", ["load_date"])
    dropped = batch.expire(spark, f"{folder}/r", "load_date", as_of="2024-04-09", days=90)
    assert len(dropped) == 9
    assert spark.read.parquet(f"{folder}/r").agg(F.min("id")).first()[0] == 9


@pytest.mark.parametrize("z_order", [False, True])
def test_compaction_keeps_rows_and_splits_a_hot_value(spark, folder, z_order):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("n")
    )
    clustered = batch.clustered(df, ["k", "n"] if z_order else ["k"], files=8, z_order=z_order)
    assert clustered.exceptAll(df).isEmpty() and df.exceptAll(clustered).isEmpty()
    sizes = [r["count"] for r in clustered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1200  # a third of the rows share one value
    df.repartition(20).write.parquet(f"{folder}/small{z_order}")
    batch.compact(spark, f"{folder}/small{z_order}", f"{folder}/large{z_order}", ["k"], z_order=z_order)
    large = spark.read.parquet(f"{folder}/large{z_order}")
    assert rows(large) == rows(df) and len(large.inputFiles()) == 1


def test_compaction_keeps_partitions_and_clusters_text(spark, folder):
    df = spark.range(2000).select(
        F.format_string("customer-%06d", F.col("id")).alias("name"), (F.col("id") % 7).alias("n"), (F.col("id") % 3).cast("int").alias("p")
    )
    df.repartition(6).write.partitionBy("p").parquet(f"{folder}/parted")
    batch.compact(spark, f"{folder}/parted", f"{folder}/whole", ["name", "n"], z_order=True)
    assert [x for x in paths.children(spark, f"{folder}/whole") if "=" in x] == ["p=0", "p=1", "p=2"]
    assert rows(spark.read.parquet(f"{folder}/whole")) == rows(df)
    cells = [r["z"] for r in df.select("name", batch.z_value(df, ["name"]).alias("z")).orderBy("name").collect()]
    assert cells == sorted(cells) and len(set(cells)) > 10


def test_compaction_gives_a_task_what_it_can_sort(spark, folder, monkeypatch):
    """Rows that compress well count by their size in memory, with partitions and without."""
    monkeypatch.setattr(batch, "SORT_BYTES", 200_000, raising=False)
    df = spark.range(4000).select(F.col("id").alias("n"), F.repeat(F.lit("x"), 200).alias("t"), (F.col("id") % 2).cast("int").alias("p"))
    df.repartition(12).write.parquet(f"{folder}/small")
    df.repartition(4).write.partitionBy("p").parquet(f"{folder}/small-parts")
    for name, z_order in (("small", False), ("small", True), ("small-parts", True)):
        batch.compact(spark, f"{folder}/{name}", f"{folder}/large", ["n", "t"], z_order=z_order)
        large = spark.read.parquet(f"{folder}/large")
        assert rows(large) == rows(df)
        files = large.groupBy(F.input_file_name()).count().collect()
        assert 4 <= len(files) <= 7 and max(r["count"] for r in files) < 1500


def test_z_order_narrows_both_columns(spark, folder):
    df = spark.range(64 * 64).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    curve = batch.clustered(df, ["x", "y"], files=16, z_order=True)
    spans = curve.groupBy(F.spark_partition_id().alias("p")).agg(
        (F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy")
    )
    worst = spans.agg(F.avg("dx"), F.avg("dy")).first()
    assert worst[0] < 32 and worst[1] < 32


def test_an_outlier_does_not_flatten_the_curve(spark, folder):
    """Files still narrow each column by their min and max, though one value lies far out and text begins alike."""
    value = F.when(F.col("id") == 77, F.lit(1e12)).otherwise(F.col("id") % 64).alias("x")
    text = F.format_string("https://host.example/path/%05d", F.floor(F.col("id") / 64)).alias("t")
    df = spark.range(64 * 64).select(value, text, F.when(F.col("id") % 9 > 0, F.col("id") % 50).alias("n"))
    df.repartition(8).write.parquet(f"{folder}/in")
    batch.clustered(df, ["x", "t"], files=16, z_order=True).write.parquet(f"{folder}/out")
    files = spark.read.parquet(f"{folder}/out").where("x < 1e11").groupBy(F.input_file_name()).agg(
        (F.max("x") - F.min("x")).alias("dx"), F.countDistinct("t").alias("dt")
    )
    assert files.count() >= 12
    worst = files.agg(F.avg("dx"), F.avg("dt")).first()
    assert worst[0] < 32 and worst[1] < 32
    bounds = batch.cell_bounds(df, ["x", "t", "n"], bits=4)
    assert len(bounds["x"]) == 15 and max(bounds["x"]) < 64 and len(bounds["t"]) == 15 and len(bounds["n"]) == 15
    assert batch.cell_bounds(df.limit(0), ["x"]) == {"x": []}


def test_writers_refuse_another_schema(spark, folder):
    good = spark.createDataFrame([(1, "a", 2)], "k int, v string, p int")
    wrong = [good.withColumn("k", F.col("k").cast("string")), good.drop("v"), good.withColumn("more", F.lit(1))]
    name = unique_name("e")
    batch.append_enforced(good, f"{folder}/a", partition_by=["p"])
    batch.replace_partitions(good, f"{folder}/r", ["p"])
    batch.overwrite_table(good, name, f"{folder}/t")
    snapshot, parts = SnapshotTable(spark, f"{folder}/s"), PartTable(spark, f"{folder}/h", ["k"], parts=2)
    snapshot.write(good)
    parts.write(good)
    for df in wrong:
        with pytest.raises(batch.SchemaMismatch):
            batch.append_enforced(df, f"{folder}/a", partition_by=["p"])
        with pytest.raises(batch.SchemaMismatch):
            batch.replace_partitions(df, f"{folder}/r", ["p"])
        with pytest.raises(batch.SchemaMismatch):
            batch.overwrite_table(df, name, f"{folder}/t")
        with pytest.raises(batch.SchemaMismatch):
            snapshot.write(df)
    for df in wrong[:2]:  # columns may be added there
        with pytest.raises(batch.SchemaMismatch):
            parts.merge(df, lambda rows, source: source)
    with pytest.raises(batch.SchemaMismatch, match="p: missing"):
        batch.replace_partitions(good.drop("p"), f"{folder}/r", ["p"])
    batch.replace_partitions(good.withColumn("more", F.lit(1)), f"{folder}/r", ["p"], merge_schema=True)
    batch.overwrite_table(wrong[0], name, f"{folder}/t", replace_schema=True)
    snapshot.write(wrong[0], replace_schema=True)
    for path in ("a", "r", "s/v=1"):
        assert spark.read.option("mergeSchema", True).parquet(f"{folder}/{path}").count() == 1


def test_bucketed_pair_joins_without_exchange(spark, folder):
    lines, orders = table(spark, SF, "lineitem"), table(spark, SF, "orders")
    skewed = lines.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(3)).otherwise(F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber", "l_quantity")
    names = unique_name("bl"), unique_name("bo")
    batch.write_bucketed_pair(
        skewed, orders.select("o_orderkey", "o_orderstatus"), "l_orderkey", "o_orderkey", names,
        (f"{folder}/l", f"{folder}/o"), buckets=8, hot_rows=500,
    )
    joined = batch.join_bucketed(spark, names, "l_orderkey", "o_orderkey")
    assert "Exchange" not in plan(joined)
    want = skewed.join(orders, skewed["l_orderkey"] == orders["o_orderkey"]).select("l_orderkey", "l_linenumber", "l_quantity", "o_orderkey", "o_orderstatus")
    assert rows(joined) == rows(want)
    salts = spark.table(names[0]).where("l_orderkey = 3").select("_salt").distinct().count()
    hot = skewed.where("l_orderkey = 3").count()
    assert salts == -(-hot // 500) > 1 and spark.table(names[1]).where("o_orderkey = 4").count() == 1


def test_partition_filters_reach_the_scan(spark, folder):
    batch.replace_partitions(batch.by_month(table(spark, SF, "orders"), "o_orderdate"), f"{folder}/g", ["year", "month"])
    pruned = spark.read.parquet(f"{folder}/g").where("year = 1997 and month >= 6").select("o_orderkey")
    text = plan(pruned)
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<o_orderkey:bigint>" in text


def test_merge_touches_only_its_partitions(spark, folder):
    path = f"{folder}/m"
    batch.replace_partitions(spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, v string, p int"), path, ["p"])
    untouched = {n: paths.children(spark, f"{path}/p=1") for n in [1]}
    source = spark.createDataFrame([(2, "B", 2), (9, "n", 4)], "k int, v string, p int")
    for _ in range(2):
        batch.merge_partitions(spark, path, source, ["k"], "p")
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "B", 2), (3, "c", 3), (9, "n", 4)]
    assert {n: paths.children(spark, f"{path}/p=1") for n in [1]} == untouched


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_formats_keep_awkward_values(spark, folder, fmt):
    df = spark.createDataFrame([(1, 'q"uo,te', 1.5), (2, "", None), (3, None, 0.1), (4, "back\\slash", -2.0)], "k int, s string, d double")
    batch.export(df, f"{folder}/{fmt}", fmt)
    back = read_files(spark, f"{folder}/{fmt}", fmt, df.schema)
    assert rows(back) == rows(df)


def test_high_water_mark(spark, folder):
    mark = HighWaterMark(spark, f"{folder}/mark")
    first = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05")], "k int, d string").withColumn("d", F.col("d").cast("date"))
    assert mark.value() is None and mark.read(first, "d").count() == 2
    mark.commit(mark.read(first, "d"), "d")
    later = first.unionByName(spark.sql("select 3 as k, date'2024-01-06' as d"))
    assert rows(mark.read(later, "d").select("k")) == [(3,)]
    mark.commit(mark.read(first, "d"), "d")  # an empty batch moves nothing
    assert mark.value() == "2024-01-05"


def test_paged_source_skips_pages_and_prunes_columns(spark, folder):
    orders = table(spark, SF, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    batch.clustered(orders, ["o_orderkey"], files=6).write.parquet(f"{folder}/pages")
    paged.register(spark)
    served = spark.read.format("paged").schema(orders.schema).option("key", "o_orderkey").load(f"{folder}/pages")
    assert served.rdd.getNumPartitions() == 6
    some = served.where("o_orderkey >= 100 and o_orderkey < 300")
    assert rows(some) == rows(orders.where("o_orderkey >= 100 and o_orderkey < 300"))
    assert some.rdd.getNumPartitions() <= 2
    assert served.where("o_orderkey = 10000000").count() == 0


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://h/db", "t", "id", 0, 1000, 8, user="u", password="p")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["user"] == "u"


def test_backfill_is_idempotent(spark, folder):
    lake = Lake(f"{folder}/lake")
    raw = {n: table(spark, SF, n) for n in ("orders", "lineitem", "customer")}
    run_medallion(spark, raw, lake, "2024-04-01")
    read = lambda name: rows(spark.read.parquet(lake.gold(name)))
    facts, mart = read("fact_sales"), read("fact_revenue_monthly")
    assert facts and mart
    for _ in range(2):
        backfill(spark, lake, "1997-03-01", "1997-06-01")
        assert read("fact_sales") == facts and read("fact_revenue_monthly") == mart


def test_merge_statement_needs_a_capable_format(spark, folder):
    name = unique_name("m")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    batch.overwrite_table(df, name, f"{folder}/m")
    with pytest.raises(Exception, match="(?i)merge"):
        batch.merge_into(df, name, ["k"])


def test_statistics_reach_the_catalog(spark, folder):
    name = unique_name("a")
    batch.overwrite_table(spark.range(7), name, f"{folder}/a")
    batch.analyze(spark, name)
    found = spark.sql(f"DESCRIBE EXTENDED {name} id").where("info_name = 'distinct_count'").first()
    assert found["info_value"] == "7"


def test_returns_by_store_and_reason(spark):
    from tidemark.operators.calendar import with_calendar
    from tidemark.operators.marts import returns_analysis

    dates = with_calendar(spark.sql("select 1 as key, date'2025-01-04' as date union all select 2, date'2025-02-28'"))
    dates = dates.drop("date_sk").withColumnRenamed("key", "date_sk")
    stores = spark.createDataFrame([(1, "North"), (2, "South")], "store_sk int, region string")
    products = spark.createDataFrame([(1, "Toys"), (2, "Food")], "product_sk int, department string")
    returns = spark.createDataFrame(
        [(1, 1, 1, 1, 2, "Damaged", 10.10), (2, 2, 1, 1, 1, "Damaged", 0.20), (3, 1, 2, 2, 1, "Defective", 5.0)],
        "sales_id int, date_sk int, store_sk int, product_sk int, returned_qty int, return_reason string, refund_amount double",
    )
    by_region = returns_analysis(returns, dates, stores, products, ["region", "return_reason"])
    assert rows(by_region) == [("North", "Damaged", 2, 3, 10.3), ("South", "Defective", 1, 1, 5.0)]
    by_month = returns_analysis(returns, dates, stores, products, ["month_name", "department"])
    assert rows(by_month) == [("February", "Toys", 1, 1, 0.2), ("January", "Food", 1, 1, 5.0), ("January", "Toys", 1, 2, 10.1)]


def test_calendar(spark):
    from tidemark.operators.calendar import date_spine, with_calendar

    span = spark.sql("select date'2024-12-30' as d union all select date'2025-03-31'")
    days = with_calendar(date_spine(span, "d"))
    got = {str(r["date"]): r for r in days.collect()}
    assert len(got) == 92
    monday, end = got["2024-12-30"], got["2025-03-31"]
    assert (monday["day_of_week"], monday["is_weekend"], monday["date_sk"]) == (1, False, 20241230)
    assert end["is_month_end"] and end["is_quarter_end"] and not end["is_quarter_start"]
    assert got["2025-01-01"]["is_quarter_start"] and got["2025-01-04"]["is_weekend"]
    assert got["2024-12-31"]["is_quarter_end"] and got["2025-02-28"]["is_month_end"]
    assert with_calendar(date_spine(span.where("false"), "d")).isEmpty()
