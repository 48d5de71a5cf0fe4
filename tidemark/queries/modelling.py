"""Facts, dimensions and change data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.calendar import date_spine, with_calendar, with_fiscal
from tidemark.operators.change_data import as_of, cdc_apply, erase, scd1, scd2, scd2_apply, surrogate_key, upsert
from tidemark.operators.joins import point_in_time
from tidemark.operators.sizing import small_side
from tidemark.queries import query
from tidemark.queries.relational import LINE_AMOUNT_SQL, line_units
from tidemark.session import table


def order_changes(spark, folder):
    """Each customer's orders as a feed of changes to their order priority."""
    return table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")


def customer_history(spark, folder):
    return scd2(order_changes(spark, folder), "o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority"])


HISTORY_SQL = """
daily as (select * from (select o_custkey, o_orderdate, o_orderpriority,
            row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) as rn from orders) where rn = 1),
runs as (select *, lag(o_orderpriority) over (partition by o_custkey order by o_orderdate) as before,
            row_number() over (partition by o_custkey order by o_orderdate) as n from daily),
history as (select o_custkey, o_orderpriority, o_orderdate as valid_from,
            lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as valid_to
            from runs where n = 1 or o_orderpriority is distinct from before)
"""


@query(
    "fact_sales",
    f"""select l_orderkey as order_id, l_linenumber as line_number, o_custkey as customer_id, l_partkey as product_id,
               o_orderdate as order_date, cast({LINE_AMOUNT_SQL} as double) as amount, l_quantity as quantity
        from lineitem join orders on l_orderkey = o_orderkey""",
)
def fact_sales(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", line_units().alias("units")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").alias("order_date"),
        (F.col("units").cast("double") / 10000).alias("amount"),
        F.col("l_quantity").alias("quantity"),
    )


@query(
    "scd2_customer",
    f"""with {HISTORY_SQL}
       select sha256(o_custkey::varchar || '|' || strftime(valid_from, '%Y-%m-%d')) as customer_id,
              o_custkey as customer_src_id, o_orderpriority as priority, valid_from, valid_to,
              valid_to is null as is_current from history""",
)
def scd2_customer(spark, folder):
    return customer_history(spark, folder).select(
        surrogate_key("o_custkey", "valid_from").alias("customer_id"),
        F.col("o_custkey").alias("customer_src_id"),
        F.col("o_orderpriority").alias("priority"),
        "valid_from",
        "valid_to",
        "is_current",
    )


@query(
    "scd2_point_in_time",
    f"""with {HISTORY_SQL}
       select o.o_orderkey, o.o_custkey, o.o_orderdate, h.o_orderpriority as priority_then
       from (select o_orderkey, o_custkey, o_orderdate + interval 45 day as o_orderdate from orders) o
       left join history h on o.o_custkey = h.o_custkey and h.valid_from <= o.o_orderdate
            and (h.valid_to is null or o.o_orderdate < h.valid_to)""",
)
def scd2_point_in_time(spark, folder):
    facts = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("interval 45 days")).alias("o_orderdate")
    )
    found = point_in_time(facts, customer_history(spark, folder), "o_custkey", "o_orderdate", ["o_orderpriority"])
    return found.withColumnRenamed("o_orderpriority", "priority_then")


@query(
    "as_of_snapshot",
    f"""with {HISTORY_SQL}
       select o_custkey, o_orderpriority, valid_from from history
       where valid_from <= timestamp '1998-06-15' and (valid_to is null or timestamp '1998-06-15' < valid_to)""",
)
def as_of_snapshot(spark, folder):
    moment = F.lit("1998-06-15").cast("timestamp_ntz")
    return as_of(customer_history(spark, folder), moment).select("o_custkey", "o_orderpriority", "valid_from")


def price_changes(spark, folder):
    """New prices of parts as they were last sold, in order of shipping."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("category"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("last_updated"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_quantity",
    )


@query(
    "scd1_product",
    """with changes as (select * from (select l_partkey as product_id, l_returnflag || '-' || l_linestatus as category,
                  l_extendedprice as price, l_shipdate as last_updated,
                  row_number() over (partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc,
                                     l_suppkey desc, l_quantity desc, l_extendedprice desc) as rn
                  from lineitem where l_quantity > 25) where rn = 1),
       dim as (select p_partkey as product_id, p_type as category, p_retailprice as price, timestamp '1990-01-01' as last_updated from part)
       select product_id, category, price, last_updated from changes
       union all select * from dim where product_id not in (select product_id from changes)""",
)
def scd1_product(spark, folder):
    dimension = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.lit("1990-01-01").cast("timestamp_ntz").alias("last_updated"),
    )
    changes = price_changes(spark, folder).where("l_quantity > 25")
    order = ["last_updated", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "price"]
    return scd1(dimension, changes, "product_id", order)


@query(
    "cdc_apply",
    """with changes as (select * from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
                        from orders) where rn = 1)
       select c_custkey, c_acctbal from customer where c_custkey not in (select o_custkey from changes)
       union all select o_custkey, o_totalprice from changes where o_orderstatus <> 'F'""",
)
def cdc_apply_query(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    changes = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        "o_orderdate",
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "O", "I").otherwise("U").alias("op"),
    )
    return cdc_apply(customer, changes, ["c_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "upsert_merge",
    """with target as (select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderdate < timestamp '1999-01-01'),
            source as (select o_orderkey, 'X' as o_orderstatus, o_totalprice * 2 as o_totalprice from orders
                       where o_orderdate >= timestamp '1998-07-01')
       select * from target where o_orderkey not in (select o_orderkey from source) union all select * from source""",
)
def upsert_merge(spark, folder):
    orders = table(spark, folder, "orders")
    target = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    source = orders.where(F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice")
    )
    return upsert(target, source, ["o_orderkey"])


@query(
    "erase_subject",
    """select o_orderkey, o_custkey, o_totalprice from orders
       where o_custkey not in (select c_custkey from customer where c_acctbal < 0)""",
)
def erase_subject(spark, folder):
    subjects = table(spark, folder, "customer").where("c_acctbal < 0").select("c_custkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return erase(orders, subjects, "o_custkey", "c_custkey")


SPINE_SQL = """(select unnest(generate_series(min(o_orderdate)::date::timestamp, max(o_orderdate)::date::timestamp,
                interval 1 day))::timestamp as d from orders)"""


@query(
    "dim_date",
    f"""select d as date, cast(strftime(d, '%Y%m%d') as bigint) as date_sk, day(d) as day, month(d) as month,
              strftime(d, '%B') as month_name, quarter(d) as quarter, year(d) as year, isodow(d) as day_of_week,
              strftime(d, '%A') as day_name, isodow(d) >= 6 as is_weekend,
              day(d + interval 1 day) = 1 as is_month_end, day(d) = 1 as is_month_start,
              day(d + interval 1 day) = 1 and month(d) % 3 = 0 as is_quarter_end,
              day(d) = 1 and month(d) % 3 = 1 as is_quarter_start
       from {SPINE_SQL}""",
)
def dim_date(spark, folder):
    days = with_calendar(date_spine(table(spark, folder, "orders"), "o_orderdate"))
    return days.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    "dim_date_fiscal",
    f"""select d as date, year(d + interval 6 month) as fiscal_year, quarter(d + interval 6 month) as fiscal_quarter,
              month(d + interval 6 month) as fiscal_period from {SPINE_SQL}""",
)
def dim_date_fiscal(spark, folder):
    days = with_fiscal(date_spine(table(spark, folder, "orders"), "o_orderdate"))
    return days.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    "scd2_incremental",
    f"""with {HISTORY_SQL}
       select o_custkey, o_orderpriority, valid_from, valid_to, valid_to is null as is_current from history""",
)
def scd2_incremental(spark, folder):
    """A dimension built from the orders before 1999, then brought up to date for customers that ordered later."""
    changes = order_changes(spark, folder)
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    shape = ("o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority"])
    dimension = scd2(changes.where(~late), *shape)
    touched = changes.where(late).select("o_custkey").distinct()
    log = changes.join(small_side(touched), "o_custkey", "left_semi")
    return scd2_apply(dimension, scd2(log, *shape), "o_custkey")
