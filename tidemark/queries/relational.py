"""Filters, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.money import hundredths, summable, to_double
from tidemark.operators.access import keyset_page
from tidemark.operators.joins import Dimension, enrich, star_join
from tidemark.operators.marts import monthly_revenue
from tidemark.operators.percentiles import exact_percentiles
from tidemark.operators.quality import column_profile
from tidemark.operators.sizing import small_side
from tidemark.queries import query
from tidemark.session import table

def line_units():
    """Net line price in units of 0.0001."""
    price, discount = hundredths(F.col("l_extendedprice")), hundredths(F.col("l_discount"))
    return summable(price * (100 - discount))


LINE_AMOUNT_SQL = "(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))))"


def money_sum(column: str):
    return to_double(F.sum(summable(hundredths(F.col(column)))), 2)


@query(
    "project_columns",
    """select l_orderkey, l_linenumber, l_quantity from lineitem""",
)
def project_columns(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_eq", "select event_id, user_id, value from events where event_type = 'purchase'")
def filter_eq(spark, folder):
    events = table(spark, folder, "events")
    return events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query(
    "filter_range",
    """select o_orderkey, o_totalprice, o_orderdate from orders
       where o_totalprice > 250000 and o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01'""",
)
def filter_range(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.where(
        (F.col("o_totalprice") > 250000)
        & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    ).select("o_orderkey", "o_totalprice", "o_orderdate")


@query(
    "filter_not_null",
    """select event_id, amount from (select event_id, case when event_type <> 'error' then value end as amount from events)
       where amount is not null""",
)
def filter_not_null(spark, folder):
    amount = F.when(F.col("event_type") != "error", F.col("value"))
    events = table(spark, folder, "events").select("event_id", amount.alias("amount"))
    return events.where(F.col("amount").isNotNull())


@query(
    "join_inner",
    """select o_orderkey, o_totalprice, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey""",
)
def join_inner(spark, folder):
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query(
    "join_left",
    """select c_custkey, c_name, o_orderkey from customer
       left join (select * from orders where o_orderstatus = 'F' and o_totalprice > 400000) o on c_custkey = o_custkey""",
)
def join_left(spark, folder):
    customer = table(spark, folder, "customer")
    orders = table(spark, folder, "orders").where("o_orderstatus = 'F' and o_totalprice > 400000")
    return customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left").select(
        "c_custkey", "c_name", "o_orderkey"
    )


@query(
    "star_join_sales",
    f"""select r_name, c_mktsegment, p_type, cast(count(*) as bigint) as line_count,
              cast(sum({LINE_AMOUNT_SQL}) as double) as revenue
       from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
            join part on l_partkey = p_partkey join nation on c_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey
       group by all""",
)
def star_join_sales(spark, folder):
    t = lambda name: table(spark, folder, name)
    lines = t("lineitem").select("l_orderkey", "l_partkey", line_units().alias("units"))
    orders = t("orders").select("o_orderkey", "o_custkey")
    # the orders get their customers first: the lines are shuffled for orders and parts only
    sold = star_join(
        orders,
        [
            Dimension(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "o_custkey", "c_custkey", "inner"),
            Dimension(t("nation").select("n_nationkey", "n_regionkey"), "c_nationkey", "n_nationkey", "inner"),
            Dimension(t("region").select("r_regionkey", "r_name"), "n_regionkey", "r_regionkey", "inner"),
        ],
    ).select("o_orderkey", "r_name", "c_mktsegment")
    star = star_join(
        lines,
        [
            Dimension(sold, "l_orderkey", "o_orderkey", "inner"),
            Dimension(t("part").select("p_partkey", "p_type"), "l_partkey", "p_partkey", "inner"),
        ],
    )
    return star.groupBy("r_name", "c_mktsegment", "p_type").agg(
        F.count(F.lit(1)).alias("line_count"), to_double(F.sum("units"), 4).alias("revenue")
    )


@query(
    "reference_enrich",
    """select s_suppkey, s_name, coalesce(n_name, 'UNKNOWN') as n_name, coalesce(r_name, 'UNKNOWN') as r_name
       from supplier left join (select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey
                                where r_name <> 'ASIA') on s_nationkey = n_nationkey""",
)
def reference_enrich(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region").where("r_name <> 'ASIA'")
    geography = nation.join(small_side(region), nation["n_regionkey"] == region["r_regionkey"])
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return enrich(supplier, geography, {"s_nationkey": "n_nationkey"}, ["n_name", "r_name"]).drop("s_nationkey")


@query(
    "sql_correlated_subquery",
    """select o_orderkey, o_custkey, o_totalprice from orders o
       where o_totalprice > (select sum(cast(i.o_totalprice as decimal(12,2)))::double / count(*) * 1.5 from orders i
                             where i.o_custkey = o.o_custkey)
         and o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def sql_correlated_subquery(spark, folder):
    return spark.sql(
        """select o_orderkey, o_custkey, o_totalprice from {orders} o
           where o_totalprice > (select cast(sum(cast(i.o_totalprice as decimal(12,2))) as double) / count(*) * 1.5
                                 from {orders} i where i.o_custkey = o.o_custkey)
             and o_custkey in (select c_custkey from {customer} where c_mktsegment = 'BUILDING')""",
        orders=table(spark, folder, "orders"),
        customer=table(spark, folder, "customer"),
    )


@query(
    "keyset_page",
    "select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey > 400 order by o_orderkey limit 1000",
)
def keyset_page_query(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return keyset_page(orders, "o_orderkey", 400, 1000)


@query(
    "sum_ignores_null",
    """select event_type, cast(sum(case when user_id % 3 <> 0 and event_type <> 'error' then cast(value as decimal(12,2)) end) as double) as amount
       from events group by event_type""",
)
def sum_ignores_null(spark, folder):
    known = (F.col("user_id") % 3 != 0) & (F.col("event_type") != "error")
    events = table(spark, folder, "events").withColumn("amount", F.when(known, F.col("value")))
    return events.groupBy("event_type").agg(money_sum("amount").alias("amount"))


@query(
    "sum_with_refunds",
    """select user_id, cast(sum(case when event_type = 'error' then -cast(value as decimal(12,2)) else cast(value as decimal(12,2)) end) as double) as amount
       from events group by user_id""",
)
def sum_with_refunds(spark, folder):
    signed = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    events = table(spark, folder, "events").withColumn("amount", signed)
    return events.groupBy("user_id").agg(money_sum("amount").alias("amount"))


@query(
    "agg_empty",
    """select event_type, cast(sum(cast(value as decimal(12,2))) as double) as amount, count(*) as n
       from events where value < 0 group by event_type""",
)
def agg_empty(spark, folder):
    events = table(spark, folder, "events").where("value < 0")
    return events.groupBy("event_type").agg(money_sum("value").alias("amount"), F.count(F.lit(1)).alias("n"))


@query(
    "early_filter_agg",
    """select event_type, cast(sum(cast(value as decimal(12,2))) as double) as amount from events
       where value > 40 group by event_type""",
)
def early_filter_agg(spark, folder):
    events = table(spark, folder, "events").select("event_type", "value").where(F.col("value") > 40)
    return events.groupBy("event_type").agg(money_sum("value").alias("amount"))


@query(
    "agg_multi_key",
    """select event_type, user_id, cast(sum(cast(value as decimal(12,2))) as double) as amount, count(*) as n
       from events group by event_type, user_id""",
)
def agg_multi_key(spark, folder):
    return table(spark, folder, "events").groupBy("event_type", "user_id").agg(
        money_sum("value").alias("amount"), F.count(F.lit(1)).alias("n")
    )


@query("distinct_values", "select distinct o_orderstatus, o_orderpriority from orders")
def distinct_values(spark, folder):
    return table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "agg_min_max",
    """select l_returnflag, l_linestatus, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship,
              min(l_extendedprice) as min_price, max(l_extendedprice) as max_price
       from lineitem group by l_returnflag, l_linestatus""",
)
def agg_min_max(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
    )


@query(
    "agg_percentile",
    """select l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) as median_price,
              round(quantile_cont(l_extendedprice, 0.9), 4) as p90_price
       from lineitem group by l_returnflag""",
)
def agg_percentile(spark, folder):
    prices = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    found = exact_percentiles(
        prices, ["l_returnflag"], "l_extendedprice", {"median_price": 0.5, "p90_price": 0.9}
    )
    return found.select(
        "l_returnflag", F.round("median_price", 4).alias("median_price"), F.round("p90_price", 4).alias("p90_price")
    )


@query(
    "latency_percentiles",
    """select event_type, round(quantile_cont(value, 0.5), 4) as p50, round(quantile_cont(value, 0.95), 4) as p95,
              round(quantile_cont(value, 0.99), 4) as p99 from events group by event_type""",
)
def latency_percentiles(spark, folder):
    found = exact_percentiles(
        table(spark, folder, "events").select("event_type", "value"),
        ["event_type"],
        "value",
        {"p50": 0.5, "p95": 0.95, "p99": 0.99},
    )
    return found.select("event_type", *[F.round(p, 4).alias(p) for p in ("p50", "p95", "p99")])


MONTHLY_SQL = f"""
select date_trunc('month', o_orderdate)::timestamp as month, c_mktsegment as segment,
       cast(sum({LINE_AMOUNT_SQL}) as double) as total_revenue,
       count(distinct o_orderkey) as order_count,
       round(cast(sum({LINE_AMOUNT_SQL}) as double) / count(distinct o_orderkey), 6) as avg_order_value
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
group by 1, 2
"""


@query("fact_revenue_monthly", MONTHLY_SQL)
def fact_revenue_monthly(spark, folder):
    t = lambda name: table(spark, folder, name)
    lines = t("lineitem").select("l_orderkey", line_units().alias("units"))
    customer = t("customer").select("c_custkey", "c_mktsegment")
    orders = star_join(
        t("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        [Dimension(customer, "o_custkey", "c_custkey", "inner")],
    )
    sales = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    monthly = monthly_revenue(sales, "o_orderdate", "c_mktsegment", "units", "o_orderkey")
    return monthly.select(
        F.col("month").cast("timestamp_ntz").alias("month"),
        "segment",
        to_double(F.col("total_revenue"), 4).alias("total_revenue"),
        "order_count",
        F.round(to_double(F.col("total_revenue"), 4) / F.col("order_count"), 6).alias("avg_order_value"),
    )


PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query(
    "column_profile",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
                   count(distinct {c}) as distinct_count, cast(min({c}) as varchar) as min_value,
                   cast(max({c}) as varchar) as max_value from orders"""
        for c in PROFILED
    ),
)
def column_profile_query(spark, folder):
    return column_profile(table(spark, folder, "orders"), PROFILED, exact=True)
