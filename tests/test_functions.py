"""Column functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.encoding import to_utf8
from tidemark.functions.masking import mask_for_role, mask_pii, tokenize
from tidemark.functions.naming import snake_case, snake_case_columns
from tidemark.functions.nested import flatten
from tidemark.functions.times import epoch_ms_to_ts, fiscal_period, fiscal_year, shape_of, to_iso_date
from tidemark.functions.typing import standardise


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_epoch_milliseconds(spark):
    df = column(spark, [0, 999, 1609459200000, -1, -1500, None], "long")
    rows = df.select(
        epoch_ms_to_ts(F.col("v")).cast("string").alias("s"), epoch_ms_to_ts(F.col("v"), "milli").cast("string").alias("m")
    ).collect()
    assert [r["s"] for r in rows] == [
        "1970-01-01 00:00:00", "1970-01-01 00:00:00", "2021-01-01 00:00:00",
        "1969-12-31 23:59:59", "1969-12-31 23:59:58", None,
    ]
    assert rows[1]["m"] == "1970-01-01 00:00:00.999" and rows[3]["m"] == "1969-12-31 23:59:59.999"
    with pytest.raises(ValueError):
        epoch_ms_to_ts(F.col("v"), "hour")


def test_dates_take_the_first_format_that_fits(spark):
    df = column(spark, ["2024-03-05", "05/03/2024", "20240305", "03/05", "2024-13-40", "", None], "string")
    iso = df.select(to_iso_date(F.col("v"), ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "M/d/yy"]).alias("d"))
    assert [r["d"] for r in iso.collect()] == ["2024-03-05", "2024-03-05", "2024-03-05", None, None, None, None]


def test_shapes():
    assert shape_of("yyyy-MM-dd HH:mm:ss.SSS") == r"^\d{4}\-\d{2}\-\d{2}\ \d{2}:\d{2}:\d{2}\.\d{3}$"
    assert shape_of("d MMM yyyy") is None
    assert shape_of("yyyy-MM-dd'T'HH") is None


def test_fiscal_year_ends_in_its_label(spark):
    df = column(spark, ["2024-06-30", "2024-07-01", "2024-12-31"], "string").select(F.col("v").cast("date").alias("d"))
    got = df.select(fiscal_year(F.col("d")).alias("y"), fiscal_period(F.col("d")).alias("p")).collect()
    assert [(r["y"], r["p"]) for r in got] == [(2024, 12), (2025, 1), (2025, 6)]
    january = df.select(fiscal_year(F.col("d"), 1).alias("y"), fiscal_period(F.col("d"), 1).alias("p")).collect()
    assert [(r["y"], r["p"]) for r in january] == [(2024, 6), (2024, 7), (2024, 12)]


def test_snake_case():
    names = ["customerID", "Customer Name", "HTTPStatus", "already_snake", " x-y ", "order.No", "%"]
    assert [snake_case(n) for n in names] == [
        "customer_id", "customer_name", "http_status", "already_snake", "x_y", "order_no", "col",
    ]


def test_colliding_names_get_numbers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-b` int, a_b int")
    assert snake_case_columns(df).columns == ["a_b", "a_b_2", "a_b_3"]


def test_flatten_structs_and_arrays(spark):
    df = spark.createDataFrame(
        [((1, ("x",)), [(10, "p"), (20, "q")]), ((2, None), [])],
        "a struct<n: int, in: struct<s: string>>, items array<struct<k: int, t: string>>",
    )
    flat = flatten(df)
    assert flat.columns == ["a_n", "a_in_s", "items"]
    rows = sorted(map(tuple, flatten(df, explode_arrays=True).collect()), key=str)
    assert rows == [(1, "x", 10, "p"), (1, "x", 20, "q"), (2, None, None, None)]


def test_types_and_error_codes(spark):
    df = spark.createDataFrame(
        [("1", "2.50", "2024-01-02"), ("x", "$3", "02.01.2024"), (None, "1e3", "soon")], "i string, d string, t string"
    )
    got = standardise(df, {"i": "int", "d": "decimal(10,2)", "t": "date"}, {"t": ["yyyy-MM-dd", "dd.MM.yyyy"]})
    rows = got.withColumn("t", F.col("t").cast("string")).withColumn("d", F.col("d").cast("string")).collect()
    assert [tuple(r) for r in rows] == [
        (1, "2.50", "2024-01-02", []),
        (None, None, "2024-01-02", ["bad_type:i", "bad_type:d"]),
        (None, "1000.00", None, ["bad_type:t"]),
    ]


def test_utf8(spark):
    df = spark.createDataFrame([(bytearray("é".encode("latin-1")), bytearray("é".encode()))], "l binary, u binary")
    row = df.select(
        to_utf8(F.col("l"), "ISO-8859-1").alias("a"), to_utf8(F.col("u")).alias("b"), to_utf8(F.col("l")).alias("c")
    ).first()
    assert (row["a"], row["b"], row["c"]) == ("é", "é", "�")


def test_masks(spark):
    text = "mail a.b+c@x-y.org or 123-45-6789, not 1123-45-67890 nor a@b"
    df = column(spark, [text, "plain", None], "string")
    got = [r["m"] for r in df.select(mask_pii(F.col("v")).alias("m")).collect()]
    assert got == ["mail ***@***.com or ***-**-***, not 1123-45-67890 nor a@b", "plain", None]
    tokens = df.select(tokenize(F.col("v"), "s").alias("t"), tokenize(F.col("v"), "r").alias("u")).collect()
    assert len(tokens[0]["t"]) == 64 and tokens[0]["t"] != tokens[0]["u"] and tokens[2]["t"] is None
    shown = mask_for_role(F.col("v"), "viewer", ["owner"], F.lit("***")), mask_for_role(F.col("v"), "owner", ["owner"], F.lit("***"))
    row = df.select(*[c.alias(f"c{i}") for i, c in enumerate(shown)]).first()
    assert (row["c0"], row["c1"]) == ("***", text)
