"""Physical plans: pushdown, pruning, broadcasts and early limits."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.access import keyset_page
from tidemark.operators.cleanse import first_per_key
from tidemark.operators.joins import Dimension, star_join
from tidemark.operators.sizing import estimated_bytes, measured_bytes, settled, small_side
import __spark_entry__  # noqa: F401  registers the queries
from tidemark.queries import QUERIES
from tidemark.session import scratch, shared_folder, shuffle_partitions, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_eq"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text
    text = plan(QUERIES["early_filter_agg"](spark, SF))
    assert "GreaterThan(value,40.0)" in text and "ReadSchema: struct<event_type:string,value:double>" in text


def test_small_dimensions_are_broadcast(spark):
    text = plan(QUERIES["star_join_sales"](spark, SF))
    assert text.count("BroadcastHashJoin") == 5 and "CartesianProduct" not in text


def test_large_sides_are_not_hinted(spark):
    orders = table(spark, SF, "orders")
    lines = table(spark, SF, "lineitem")
    assert "broadcast" in small_side(orders)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in small_side(orders, limit=10)._jdf.queryExecution().logical().toString()
    assert estimated_bytes(lines.crossJoin(orders)) > estimated_bytes(lines)
    assert settled(orders, "x") is orders
    copy = settled(orders, "x", limit=10)
    assert copy is not orders and copy.count() == orders.count()


def test_sizes_that_only_look_small_are_not_hinted(spark, folder):
    hinted = lambda df: "broadcast" in small_side(df, limit=2**20)._jdf.queryExecution().logical().toString()
    generated = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(500_000))).alias("n"))
    assert estimated_bytes(generated) < 100 and not hinted(generated)
    spark.range(20_000).select(F.repeat(F.lit("same text "), 20).alias("t")).write.parquet(f"{folder}/same")
    same = spark.read.parquet(f"{folder}/same")
    assert estimated_bytes(same) < 2**20 < measured_bytes(same) and not hinted(same)
    assert hinted(table(spark, SF, "nation"))


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(first_per_key(table(spark, SF, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_page_is_a_top_k(spark):
    text = plan(keyset_page(table(spark, SF, "orders"), "o_orderkey", 100, 10))
    assert "TakeOrderedAndProject" in text and "GreaterThan(o_orderkey,100)" in text


def test_no_query_pairs_everything_with_everything(spark):
    cheap = ["impute_group_mean", "outlier_iqr", "outlier_zscore", "feature_ratio", "scd2_point_in_time", "rls_filtered"]
    for name in cheap:
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_distinct_and_sums_combine_before_the_shuffle(spark):
    text = plan(QUERIES["agg_multi_key"](spark, SF))
    assert text.count("HashAggregate") == 2


def test_star_join_keeps_fact_rows(spark):
    lines, parts = table(spark, SF, "lineitem"), table(spark, SF, "part").where("p_partkey < 10")
    joined = star_join(lines, [Dimension(parts, "l_partkey", "p_partkey")])
    assert joined.count() == lines.count() and "p_partkey" not in joined.columns


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "a") != scratch(spark, "a")


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 2**30, 8) == 40
    assert shuffle_partitions(100 * 2**40, 4000) == 100_000


def test_rides_prune(spark):
    frame = table(spark, SF, "events").groupBy("event_type").agg(F.sum("value"))
    assert "ReadSchema: struct<event_type:string,value:double>" in plan(frame)


@pytest.mark.parametrize("name", ["mask_pii", "tokenize", "type_standardise", "json_flatten", "date_multi_format"])
def test_expressions_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "Arrow" not in text


def jobs(spark, make):
    """Number of Spark jobs that building a DataFrame starts; each file that is read takes one, for its schema."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{make.__hash__()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        make()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sources_are_not_run_to_be_measured(spark):
    # the group values are computed once, into the copy that is joined; files were measured by the first run
    for name, most in (("outlier_iqr", 3), ("outlier_zscore", 3), ("impute_group_mean", 3), ("cdc_apply", 2), ("scd1_product", 2)):
        QUERIES[name](spark, SF)
        assert jobs(spark, lambda: QUERIES[name](spark, SF)) <= most, name  # noqa: B023
    QUERIES["star_join_sales"](spark, SF)
    assert jobs(spark, lambda: QUERIES["star_join_sales"](spark, SF)) <= 6


def test_many_rows_in_a_small_file_are_not_taken_for_few(spark, folder):
    from tidemark.operators.sizing import known_few

    spark.range(50_000).select(F.lit("same").alias("k")).coalesce(1).write.parquet(f"{folder}/t")
    small = spark.read.parquet(f"{folder}/t")
    assert known_few(small, 100_000) and not known_few(small, 49_999)
    assert not known_few(small.groupBy("k").count(), 10**9)


def test_a_stored_copy_knows_its_size(spark):
    from tidemark.operators.sizing import known_small, stored

    text = spark.range(20_000).select("id", F.repeat(F.lit("same text "), 20).alias("t"))
    copy = stored(text, "sized")
    assert jobs(spark, lambda: known_small(copy.withColumnRenamed("t", "u"), 2**20)) == 0
    assert not known_small(copy, 2**20) and known_small(copy, 2**24) and known_small(copy.where("id < 9"), 2**24)
    # nothing that computes is run to learn its size
    assert jobs(spark, lambda: known_small(copy.groupBy("t").count(), 2**30)) == 0


def test_changes_are_applied_in_one_shuffle(spark):
    for name in ("cdc_apply", "scd1_product"):
        text = plan(QUERIES[name](spark, SF))
        assert text.count("FileScan") == 2, name
        assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text and "Join" not in text, name
