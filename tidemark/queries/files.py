"""Batch sources and sinks: formats, layouts, retention, clustering, buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.medallion import LINE_KEY, LINE_ORDER, monthly_revenue_pipeline
from tidemark.operators.sizing import small_side, stored
from tidemark.queries import query
from tidemark.queries.relational import LINE_AMOUNT_SQL
from tidemark.session import scratch, table, unique_name
from tidemark.sinks import batch
from tidemark.sources import paged
from tidemark.sources.readers import HighWaterMark, convert_files, read_files

FORMATS = ("csv", "json", "parquet", "orc")
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def day(text):
    return F.lit(text).cast("timestamp_ntz")


@query(
    "formats_roundtrip",
    " union all ".join(f"select '{f}' as format, {ORDER_COLUMNS} from orders" for f in (*FORMATS, "csv to parquet")),
)
def formats_roundtrip(spark, folder):
    orders = table(spark, folder, "orders")
    root = scratch(spark, "formats")
    read = []
    for fmt in FORMATS:
        batch.export(orders, f"{root}/{fmt}", fmt)
        read.append(read_files(spark, f"{root}/{fmt}", fmt, ORDERS).withColumn("format", F.lit(fmt)))
    convert_files(spark, f"{root}/csv", "csv", f"{root}/converted", ORDERS)
    read.append(spark.read.parquet(f"{root}/converted").withColumn("format", F.lit("csv to parquet")))
    together = read[0]
    for other in read[1:]:
        together = together.unionByName(other)
    return together


@query(
    "incremental_since",
    "select o_orderkey, o_orderdate from orders where o_orderdate > timestamp '1999-12-31'",
)
def incremental_since(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    mark = HighWaterMark(spark, scratch(spark, "mark"))
    first_run = mark.read(orders.where(F.col("o_orderdate") <= day("1999-12-31")), "o_orderdate")
    mark.commit(first_run, "o_orderdate")
    return mark.read(orders, "o_orderdate")


@query(
    "paged_source",
    "select o_orderkey, o_totalprice from orders where o_orderkey >= 500 and o_orderkey < 9000 and o_totalprice > 1000",
)
def paged_source(spark, folder):
    pages = scratch(spark, "pages")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    batch.clustered(orders, ["o_orderkey"], files=8).write.parquet(pages)
    paged.register(spark)
    served = spark.read.format("paged").schema(orders.schema).option("key", "o_orderkey").load(pages)
    return served.where("o_orderkey >= 500 and o_orderkey < 9000 and o_totalprice > 1000")


@query(
    "silver_orders",
    """select o_orderkey, o_custkey, o_orderdate as order_date, coalesce(case when o_orderstatus <> 'P' then o_totalprice end, 0) as amount
       from orders""",
)
def silver_orders(spark, folder):
    from tidemark.operators.cleanse import fill_defaults, first_per_key
    from tidemark.operators.quality import assert_quality, in_range, required

    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount"),
    )
    clean = first_per_key(raw, ["o_orderkey"], ["order_date", "o_custkey", "amount"])
    clean = fill_defaults(clean, {"amount": 0.0})
    clean = clean.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    staged = stored(clean, "silver-orders-staged")
    assert_quality(staged, [required("order_date"), in_range("amount", 0)])  # a failing gate leaves the table as it was
    name = unique_name("silver_orders")
    batch.overwrite_table(staged, name, scratch(spark, "silver-orders"))
    return spark.table(name)


@query(
    "bronze_partition_counts",
    """select strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as load_date, 'erp' as source_system, count(*) as n
       from orders group by 1""",
)
def bronze_partition_counts(spark, folder):
    path = scratch(spark, "bronze-orders")
    orders = table(spark, folder, "orders")
    month = F.date_format(F.date_trunc("month", F.col("o_orderdate").cast("timestamp")), "yyyy-MM-dd")
    stamped = orders.withColumns({"load_date": month, "source_system": F.lit("erp")})
    batch.replace_partitions(stamped, path, ["load_date", "source_system"])
    landed = spark.read.parquet(path)
    return landed.groupBy(F.col("load_date").cast("string").alias("load_date"), "source_system").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "gold_partition_pruned",
    """select year(o_orderdate) as year, month(o_orderdate) as month, count(*) as n,
              cast(sum(cast(o_totalprice as decimal(12,2))) as double) as amount
       from orders where year(o_orderdate) = 1997 and month(o_orderdate) >= 6 group by 1, 2""",
)
def gold_partition_pruned(spark, folder):
    path = scratch(spark, "gold-orders")
    batch.replace_partitions(batch.by_month(table(spark, folder, "orders"), "o_orderdate"), path, ["year", "month"])
    pruned = spark.read.parquet(path).where("year = 1997 and month >= 6")
    return pruned.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("amount"),
    )


@query(
    "retention_90d",
    """select event_id, strftime(ts, '%Y-%m-%d') as load_date from events
       where ts >= timestamp '2024-04-09' - interval 90 day""",
)
def retention_90d(spark, folder):
    path = scratch(spark, "retained-events")
    events = table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("load_date"))
    batch.replace_partitions(events, path, ["load_date"])
    batch.expire(spark, path, "load_date", as_of="2024-04-09", days=90)
    return spark.read.parquet(path).select("event_id", F.col("load_date").cast("string").alias("load_date"))


LINES = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate"


@query("compact_preserves_rows", f"select {LINES} from lineitem")
def compact_preserves_rows(spark, folder):
    root = scratch(spark, "compaction")
    lines = table(spark, folder, "lineitem").select(*LINES.split(", "))
    lines.repartition(32).write.parquet(f"{root}/small")
    batch.compact(spark, f"{root}/small", f"{root}/large", ["l_partkey", "l_shipdate"], z_order=True)
    return spark.read.parquet(f"{root}/large")


@query("compact_partitioned", f"select {LINES}, l_returnflag as stored_under from lineitem")
def compact_partitioned(spark, folder):
    """A partitioned table stays one, here clustered along a text column as well."""
    root = scratch(spark, "compaction-parts")
    lines = table(spark, folder, "lineitem").select(*LINES.split(", "), "l_returnflag", F.col("l_linestatus").alias("status"))
    lines.repartition(batch.sort_tasks(lines, 8)).write.partitionBy("l_returnflag").parquet(f"{root}/small")
    batch.compact(spark, f"{root}/small", f"{root}/large", ["status", "l_partkey"], z_order=True)
    folder_of = F.regexp_extract("_metadata.file_path", "/l_returnflag=([^/]*)/", 1)
    return spark.read.parquet(f"{root}/large").select(*LINES.split(", "), folder_of.alias("stored_under"))


@query(
    "bucketed_join",
    """select o_orderpriority, count(*) as line_count, cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as gross
       from lineitem join orders on l_orderkey = o_orderkey group by o_orderpriority""",
)
def bucketed_join(spark, folder):
    root = scratch(spark, "buckets")
    names = unique_name("lines"), unique_name("orders")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    batch.write_bucketed_pair(lines, orders, "l_orderkey", "o_orderkey", names, (f"{root}/lines", f"{root}/orders"))
    joined = batch.join_bucketed(spark, names, "l_orderkey", "o_orderkey")
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("gross"),
    )


@query(
    "preagg_refresh",
    """select o_orderstatus, date_trunc('month', o_orderdate)::timestamp as month, count(*) as n,
              cast(sum(cast(o_totalprice as decimal(12,2))) as double) as amount from orders group by 1, 2""",
)
def preagg_refresh(spark, folder):
    """Build the mart without half of one year's orders, then refresh the months they belong to."""
    path = scratch(spark, "preagg")
    orders = table(spark, folder, "orders").withColumn(
        "month", F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    )
    late = (F.col("o_orderstatus") == "P") & (F.year("o_orderdate") == 1998)

    def aggregate(df):
        return df.groupBy("o_orderstatus", "month").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("amount")
        ).withColumn("month_key", F.date_format("month", "yyyy-MM"))

    batch.replace_partitions(aggregate(orders.where(~late)), path, ["month_key"])
    touched = orders.where(late).select("month").distinct()
    batch.replace_partitions(aggregate(orders.join(small_side(touched), "month", "left_semi")), path, ["month_key"])
    return spark.read.parquet(path).select(
        "o_orderstatus",
        F.col("month").cast("timestamp_ntz").alias("month"),
        "n",
        F.col("amount").cast("double").alias("amount"),
    )


@query(
    "merge_touched_partitions",
    """with s as (select o_orderkey, o_orderstatus, o_totalprice + 1 as o_totalprice, year(o_orderdate) as year from orders
                  where year(o_orderdate) >= 2000 and o_orderstatus = 'O')
       select o_orderkey, o_orderstatus, o_totalprice, year(o_orderdate) as year from orders
       where year(o_orderdate) < 2001 and o_orderkey not in (select o_orderkey from s)
       union all select * from s""",
)
def merge_touched_partitions(spark, folder):
    path = scratch(spark, "merged-orders")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    batch.replace_partitions(orders.where("year < 2001"), path, ["year"])
    source = orders.where("year >= 2000 and o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    batch.merge_partitions(spark, path, source, ["o_orderkey"], "year")
    return spark.read.parquet(path).withColumn("year", F.col("year").cast("bigint"))


@query(
    "medallion_revenue",
    f"""with lines as (select * from (select *, row_number() over (partition by {', '.join(LINE_KEY)}
                       order by {', '.join(LINE_ORDER)}) as rn from lineitem) where rn = 1)
       select date_trunc('month', o_orderdate)::timestamp as month, c_mktsegment as segment,
              cast(sum({LINE_AMOUNT_SQL}) as double) as total_revenue, count(distinct o_orderkey) as order_count,
              round(cast(sum({LINE_AMOUNT_SQL}) as double) / count(distinct o_orderkey), 6) as avg_order_value
       from lines join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey group by 1, 2""",
)
def medallion_revenue(spark, folder):
    return monthly_revenue_pipeline(spark, folder)
