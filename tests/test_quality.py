"""Rules, quarantine, gates and schema checks."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.access import columns_for_role, keyset_page, reachable, rows_for_role

RULES = [dq.required("id"), dq.in_range("n", 0, 10), dq.matches("t", "^[a-z]+$"), dq.one_of("s", ["x", "y"])]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, 5, "abc", "x"), (None, 11, "ABC", "z"), (2, None, None, None), (3, -1, "a1", "y"), (3, 0, "q", "x")],
        "id int, n int, t string, s string",
    )


def test_valid_and_quarantined_make_the_whole(spark, df, folder):
    path = f"{folder}/checked"
    dq.write_checked(df, RULES, path)
    good, bad = dq.read_valid(spark, path), dq.read_quarantined(spark, path)
    assert good.count() == 3 and bad.count() == 2 and good.columns == df.columns
    codes = {r["id"]: r["_errors"] for r in bad.collect()}
    assert codes[None] == ["missing:id", "range:n", "pattern:t", "domain:s"] and codes[3] == ["range:n", "pattern:t"]
    assert good.unionByName(bad.drop("_errors")).exceptAll(df).isEmpty()
    assert dq.remove_invalid(df, RULES).count() == 3
    assert dq.quarantine(df, RULES).count() == 2


def test_scores(df):
    row = dq.quality_score(df, RULES).first()
    assert (row["total_rows"], row["valid_rows"], row["score"], row["meets_target"]) == (5, 3, 60.0, False)
    empty = dq.quality_score(df.where("false"), RULES).first()
    assert empty["score"] is None
    row = dq.ingest_metrics(df, RULES).first()
    assert tuple(row) == (5, 3, 2)


def test_column_metrics(df):
    nulls = {r["column_name"]: (r["null_count"], r["null_pct"]) for r in dq.null_profile(df).collect()}
    assert nulls == {"id": (1, 20.0), "n": (1, 20.0), "t": (1, 20.0), "s": (1, 20.0)}
    full = {r["column_name"]: r["completeness_pct"] for r in dq.completeness(df, ["id", "n"]).collect()}
    assert full == {"id": 80.0, "n": 80.0}
    wrong = {r["column_name"]: r["mismatch_count"] for r in dq.type_mismatches(df, {"t": "int", "s": "double"}).collect()}
    assert wrong == {"t": 4, "s": 4}
    failed = {r["rule"]: r["failed_count"] for r in dq.rule_metrics(df, RULES).collect()}
    assert failed == {"missing:id": 1, "range:n": 2, "pattern:t": 2, "domain:s": 1}
    profile = {r["column_name"]: r.asDict() for r in dq.column_profile(df, ["id", "t"], exact=True).collect()}
    assert profile["id"]["distinct_count"] == 3 and profile["id"]["min_value"] == "1"
    rough = {r["column_name"]: r["distinct_count"] for r in dq.column_profile(df, ["id"]).collect()}
    assert rough == {"id": 3}
    typed = dq.rule_metrics(df, [dq.typed("t", "int")]).first()
    assert typed["failed_count"] == 4


def test_keys(df):
    assert [(r["id"], r["copies"]) for r in dq.duplicates(df, ["id"]).collect()] == [(3, 2)]
    assert tuple(dq.uniqueness(df, ["id"]).first()) == (5, 4, 1)
    assert tuple(dq.uniqueness(df.where("false"), ["id"]).first()) == (0, 0, 0)
    assert dq.row_count_check(df, 1, 4).first()["in_bounds"] is False


def test_freshness(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 20:00:00"), ("c", "2023-01-01 00:00:00")], "k string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp"))
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    got = {r["k"]: (r["age_hours"], r["status"]) for r in dq.freshness(df, "t", as_of, by=["k"]).collect()}
    assert got["a"] == (24.0, "yellow") and got["b"] == (4.0, "green") and got["c"][1] == "red"


def test_gate(df):
    assert dq.assert_quality(df.where("n = 5"), RULES) == {"rows": 1}
    with pytest.raises(dq.QualityError, match="range:n"):
        dq.assert_quality(df, RULES)
    with pytest.raises(dq.QualityError, match="0 rows"):
        dq.assert_quality(df.where("false"), RULES)


def test_schema_findings(spark, df):
    expected = spark.createDataFrame([], "id int, n string, extra date").schema
    found = {r["column_name"]: (r["finding"], r["expected_type"], r["actual_type"]) for r in dq.schema_report(df, expected).collect()}
    assert found == {
        "n": ("mistyped", "string", "int"), "extra": ("missing", "date", None),
        "t": ("extra", None, "string"), "s": ("extra", None, "string"),
    }
    assert dq.schema_findings(df.schema, df.schema) == []


def test_file_integrity(spark, df, folder):
    df.repartition(2).write.parquet(f"{folder}/files")
    found = dq.file_integrity(spark.read.parquet(f"{folder}/files")).collect()
    assert sum(r["row_count"] for r in found) == 5 and all(r["file_size"] > 0 for r in found)


def test_policies(spark, df):
    rows = spark.createDataFrame([("eu", "x"), ("us", "y")], "role string, attribute string")
    assert {r["s"] for r in rows_for_role(df, rows, "eu", "s").collect()} == {"x"}
    assert rows_for_role(df, rows, "nobody", "s").isEmpty()
    columns = spark.createDataFrame([("eu", "n"), ("eu", "id"), ("eu", "absent")], "role string, column_name string")
    assert columns_for_role(df, columns, "eu").columns == ["id", "n"]


def test_pages_cover_everything_once(spark):
    df = spark.range(0, 95).withColumnRenamed("id", "k")
    seen, cursor = [], None
    while True:
        page = [r["k"] for r in keyset_page(df, "k", cursor, 20).collect()]
        if not page:
            break
        seen += page
        cursor = page[-1]
    assert seen == list(range(95))


def test_lineage_with_a_diamond_and_a_cycle(spark, folder):
    edges = spark.createDataFrame(
        [("raw", "silver"), ("silver", "fact"), ("silver", "dim"), ("fact", "mart"), ("dim", "mart"), ("mart", "report"), ("report", "silver"), ("o", "p")],
        "source string, target string",
    )
    down = {r["table"]: r["distance"] for r in reachable(edges, "raw", folder=f"{folder}/down").collect()}
    assert down == {"silver": 1, "fact": 2, "dim": 2, "mart": 3, "report": 4}
    up = {r["table"] for r in reachable(edges, "mart", upstream=True, folder=f"{folder}/up").collect()}
    assert up == {"fact", "dim", "silver", "raw", "report"}


def test_only_bad_rows_are_written_and_all_counted(spark, folder):
    df = spark.range(10).select(F.when(F.col("id") > 2, F.col("id")).alias("k"))
    assert dq.write_quarantined(df, [dq.required("k")], f"{folder}/q") == (10, 3)
    bad = spark.read.parquet(f"{folder}/q")
    assert bad.count() == 3 and {r.checked for r in bad.collect()} == {"quarantined"}
