"""Gold tables: sales facts, monthly revenue and returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import Dimension, star_join


def monthly_revenue(sales: DataFrame, day: str, segment: str, amount: str, order_id: str) -> DataFrame:
    """Revenue, distinct orders and average order value per month and segment.

    Lines are first summed per order: the distinct count becomes a plain count
    and the second aggregation moves one row per order at most.
    """
    per_order = sales.groupBy(
        F.date_trunc("month", F.col(day).cast("timestamp")).alias("month"), F.col(segment).alias("segment"), order_id
    ).agg(F.sum(amount).alias("_order_amount"))
    return per_order.groupBy("month", "segment").agg(
        F.sum("_order_amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        (F.sum("_order_amount").cast("double") / F.count(F.lit(1))).alias("avg_order_value"),
    )


def returns_analysis(
    returns: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame, by: Sequence[str | Column]
) -> DataFrame:
    """Returned quantity, refunds and number of returns by any star attributes."""
    star = star_join(
        returns,
        [
            Dimension(dates, "date_sk", "date_sk"),
            Dimension(stores, "store_sk", "store_sk"),
            Dimension(products, "product_sk", "product_sk"),
        ],
    )
    return star.groupBy(*by).agg(
        F.count(F.lit(1)).alias("returns"),
        F.sum("returned_qty").alias("returned_qty"),
        F.sum(F.col("refund_amount").cast("decimal(18,2)")).cast("double").alias("refund_total"),
    )
