"""Window functions and the features built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.features import bucket_by_edges, duration_regression, growth_alert, ntile, ratio_to_total
from tidemark.operators.sequences import KeySequence, ranks
from tidemark.queries import query
from tidemark.session import table


@query(
    "win_row_number",
    """select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as rn from events""",
)
def win_row_number(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return KeySequence(events, ["user_id"], ["ts", "event_id"]).add(row_number="rn").drop("ts")


@query(
    "win_lag_lead",
    """select event_id, lag(value) over w as previous_value, lead(ts) over w as next_ts
       from events window w as (partition by user_id order by ts, event_id)""",
)
def win_lag_lead(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return (
        KeySequence(events, ["user_id"], ["ts", "event_id"])
        .add(lag={"previous_value": "value"}, lead={"next_ts": "ts"})
        .select("event_id", "previous_value", "next_ts")
    )


@query(
    "win_rank",
    """select l_orderkey, l_linenumber, l_quantity, l_suppkey, l_shipdate,
              rank() over (partition by l_suppkey order by l_quantity desc) as quantity_rank,
              dense_rank() over (partition by l_suppkey order by l_quantity desc) as quantity_dense_rank
       from lineitem""",
)
def win_rank(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_shipdate"
    )
    return ranks(lines, ["l_suppkey"], ["-l_quantity"], "quantity_rank", "quantity_dense_rank")


@query(
    "feature_buckets",
    """select event_id, ntile(4) over (partition by event_type order by value, event_id) as quartile,
              case when value < 10 then 'low' when value < 50 then 'medium' when value < 100 then 'high' else 'top' end as band
       from events""",
)
def feature_buckets(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    banded = events.withColumn("band", bucket_by_edges(F.col("value"), [10, 50, 100], ["low", "medium", "high", "top"]))
    return ntile(banded, ["event_type"], ["value", "event_id"], 4, "quartile").select("event_id", "quartile", "band")


@query(
    "feature_ratio",
    """select event_id, round(value / nullif(cast(sum(cast(value as decimal(12,2))) over (partition by user_id) as double), 0), 9) as share
       from events""",
)
def feature_ratio(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.col("value").cast("decimal(12,2)").alias("amount")
    )
    shares = ratio_to_total(events, ["user_id"], "amount", "share")
    return shares.select("event_id", F.round("share", 9).alias("share"))


@query(
    "growth_alert",
    """with monthly as (select o_orderpriority, date_trunc('month', o_orderdate)::timestamp as month, count(*) as volume
                        from orders group by 1, 2),
            lagged as (select *, lag(volume) over (partition by o_orderpriority order by month) as previous_volume from monthly)
       select o_orderpriority, month, volume, previous_volume,
              round((volume::double - previous_volume) / previous_volume::double, 9) as growth,
              coalesce((volume::double - previous_volume) / previous_volume::double > 0.10, false) as is_alert
       from lagged""",
)
def growth_alert_query(spark, folder):
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("month")
    monthly = table(spark, folder, "orders").groupBy("o_orderpriority", month).agg(F.count(F.lit(1)).alias("volume"))
    return growth_alert(monthly, ["o_orderpriority"], "month", "volume").select(
        "o_orderpriority",
        F.col("month").cast("timestamp_ntz").alias("month"),
        "volume",
        "previous_volume",
        F.round("growth", 9).alias("growth"),
        "is_alert",
    )


@query(
    "duration_regression",
    """with timed as (select event_id, event_type, ts, cast(value as decimal(12,2)) as duration from events),
            seen as (select *, cast(sum(duration) over w as double) / count(duration) over w as expected from timed
                     window w as (partition by event_type order by ts, event_id rows between unbounded preceding and 1 preceding))
       select event_id, cast(duration as double) as duration, round(expected, 6) as expected,
              coalesce(cast(duration as double) >= expected * 2, false) as is_regression
       from seen""",
)
def duration_regression_query(spark, folder):
    timed = table(spark, folder, "events").select(
        "event_id", "event_type", "ts", F.col("value").cast("decimal(12,2)").alias("duration")
    )
    return duration_regression(timed, ["event_type"], ["ts", "event_id"], "duration").select(
        "event_id",
        F.col("duration").cast("double").alias("duration"),
        F.round("expected", 6).alias("expected"),
        "is_regression",
    )
