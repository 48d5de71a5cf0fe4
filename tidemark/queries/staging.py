"""Standardisation and cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.naming import snake_case_columns
from tidemark.functions.nested import flatten
from tidemark.functions.times import epoch_ms_to_ts, to_iso_date
from tidemark.functions.typing import standardise
from tidemark.operators.cleanse import fill_defaults, impute, iqr_outliers, zscore_outliers
from tidemark.queries import query
from tidemark.session import table


def ms_of(column):
    return F.unix_millis(F.col(column).cast("timestamp"))


@query(
    "epoch_ms_to_ts",
    """select event_id, epoch_us(ts) // 1000 as ms, date_trunc('second', ts)::timestamp as at_second,
              make_timestamp(epoch_us(ts) // 1000 * 1000) as at_milli from events""",
)
def epoch_ms_to_ts_query(spark, folder):
    events = table(spark, folder, "events").select("event_id", ms_of("ts").alias("ms"))
    return events.select(
        "event_id",
        "ms",
        epoch_ms_to_ts(F.col("ms")).cast("timestamp_ntz").alias("at_second"),
        epoch_ms_to_ts(F.col("ms"), "milli").cast("timestamp_ntz").alias("at_milli"),
    )


@query(
    "snake_case_columns",
    """select c_custkey as customer_key, c_name as customer_name, c_name as customer_name_2,
              c_acctbal as acct_bal, c_mktsegment as market_segment from customer""",
)
def snake_case_query(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customerKey"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_name").alias("customer-name"),
        F.col("c_acctbal").alias("AcctBal"),
        F.col("c_mktsegment").alias("market.segment"),
    )
    return snake_case_columns(customer)


@query(
    "json_flatten",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as payload_props_k,
              event_type as payload_kind, user_id as payload_who_user_id from events""",
)
def json_flatten(spark, folder):
    events = table(spark, folder, "events")
    payload = F.to_json(
        F.struct(
            F.from_json("props", "k bigint").alias("props"),
            F.col("event_type").alias("kind"),
            F.struct("user_id").alias("who"),
        )
    )
    nested = "props struct<k: bigint>, kind string, who struct<user_id: bigint>"
    return flatten(events.select("event_id", F.from_json(payload, nested).alias("payload")))


DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd"]


@query(
    "date_multi_format",
    """select o_orderkey, case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then null
              else strftime(o_orderdate, '%Y-%m-%d') end as iso_date from orders""",
)
def date_multi_format(spark, folder):
    written = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("no date"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", written.alias("written"))
    return orders.select("o_orderkey", to_iso_date(F.col("written"), DATE_FORMATS).alias("iso_date"))


@query(
    "type_standardise",
    """select o_orderkey, case when o_orderstatus = 'P' then null else o_totalprice end as price,
              o_orderdate as ordered_at, try_cast(o_orderpriority as integer) as priority,
              concat_ws(',', case when o_orderstatus = 'P' then 'bad_type:price' end,
                        case when try_cast(o_orderpriority as integer) is null then 'bad_type:priority' end) as errors
       from orders""",
)
def type_standardise(spark, folder):
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("$"), F.col("o_totalprice")))
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("price"),
        F.date_format("o_orderdate", "yyyy/MM/dd HH:mm").alias("ordered_at"),
        F.col("o_orderpriority").alias("priority"),
    )
    typed = standardise(
        raw,
        {"price": "decimal(12,2)", "ordered_at": "timestamp", "priority": "int"},
        {"ordered_at": ["yyyy/MM/dd HH:mm"]},
    )
    return typed.select(
        "o_orderkey",
        F.col("price").cast("double").alias("price"),
        F.col("ordered_at").cast("timestamp_ntz").alias("ordered_at"),
        "priority",
        F.array_join("_errors", ",").alias("errors"),
    )


def gappy_events(spark, folder):
    """Events whose value is missing for a third of the users and for all errors."""
    known = (F.col("user_id") % 3 != 0) & (F.col("event_type") != "error")
    return table(spark, folder, "events").select(
        "event_id", "event_type", "user_id", F.when(known, F.col("value").cast("decimal(12,2)")).alias("amount")
    )


GAPPY_SQL = """(select event_id, event_type, user_id,
  case when user_id % 3 <> 0 and event_type <> 'error' then cast(value as decimal(12,2)) end as amount from events)"""


@query(
    "fill_default",
    f"select event_id, event_type, user_id, cast(coalesce(amount, 0) as double) as amount from {GAPPY_SQL}",
)
def fill_default(spark, folder):
    filled = fill_defaults(gappy_events(spark, folder), {"amount": 0})
    return filled.withColumn("amount", F.col("amount").cast("double"))


@query(
    "impute_group_mean",
    f"""with g as {GAPPY_SQL},
        m as (select event_type, cast(sum(amount) as double) / count(amount) as mean from g group by event_type),
        a as (select cast(sum(amount) as double) / count(amount) as mean from g)
       select event_id, event_type, user_id, round(coalesce(cast(amount as double), m.mean, a.mean), 4) as amount
       from g join m using (event_type), a""",
)
def impute_group_mean(spark, folder):
    events = gappy_events(spark, folder)
    filled = impute(events, "amount", ["event_type"])
    return filled.withColumn("amount", F.round(F.col("amount").cast("double"), 4))


@query(
    "impute_group_median",
    f"""with g as (select event_id, event_type, user_id, cast(amount as double) as amount from {GAPPY_SQL}),
        m as (select event_type, quantile_cont(amount, 0.5) as median from g group by event_type),
        a as (select quantile_cont(amount, 0.5) as median from g)
       select event_id, event_type, user_id, round(coalesce(amount, m.median, a.median), 6) as amount
       from g join m using (event_type), a""",
)
def impute_group_median(spark, folder):
    events = gappy_events(spark, folder).withColumn("amount", F.col("amount").cast("double"))
    filled = impute(events, "amount", ["event_type"], method="median")
    return filled.withColumn("amount", F.round("amount", 6))


@query(
    "outlier_zscore",
    """with s as (select event_type, avg(value) as mean, stddev_samp(value) as sd from events group by event_type)
       select event_id, event_type, value, round((value - mean) / sd, 6) as z_score,
              abs((value - mean) / sd) > 3 as is_outlier
       from events join s using (event_type)""",
)
def outlier_zscore(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return zscore_outliers(events, "value", ["event_type"]).withColumn("z_score", F.round("z_score", 6))


@query(
    "outlier_iqr",
    """with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
                  from events group by event_type)
       select event_id, event_type, value,
              value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1) as is_outlier
       from events join q using (event_type)""",
)
def outlier_iqr(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return iqr_outliers(events, "value", ["event_type"])
