"""The ways taken for large inputs must give the rows of the SQL as well.

All size limits are lowered, so that the small test tables count as huge: keys
are cut into slices, group values are written first, and nothing is broadcast.
"""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points
from tidemark.operators import percentiles, sequences, sizing

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "win_row_number", "win_lag_lead", "win_rank", "feature_buckets", "feature_ratio", "duration_regression",
    "agg_percentile", "latency_percentiles", "outlier_iqr", "outlier_zscore", "impute_group_mean", "impute_group_median",
    "scd2_customer", "scd2_point_in_time", "as_of_snapshot", "star_join_sales", "upsert_merge", "cdc_apply", "rls_filtered",
    "erase_subject", "bucketed_join",
]


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.fixture
def everything_is_large(spark, monkeypatch):
    monkeypatch.setattr(sizing.small_side, "__defaults__", (0,))
    monkeypatch.setattr(sizing.settled, "__defaults__", (0,))
    monkeypatch.setattr(sequences.KeySequence.__init__, "__defaults__", (0, 40, 4, None))
    monkeypatch.setattr(sequences.ranks, "__defaults__", (None, None, 0))
    monkeypatch.setattr(percentiles.exact_percentiles, "__defaults__", (40, 64))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", NAMES)
def test_large_path(spark, connection, everything_is_large, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert differences(frame, connection, entry_points.oracle_sql()[name]) is None
