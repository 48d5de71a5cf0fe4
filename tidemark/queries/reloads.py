"""What a second load must not break: repeated, partial and incomplete input."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.change_data import cdc_apply, upsert
from tidemark.plans.medallion import Lake, backfill, read_monthly, run_medallion
from tidemark.queries import SQL, query
from tidemark.session import scratch, table
from tidemark.sinks.batch import merge_partitions, replace_partitions
from tidemark.sources.readers import HighWaterMark, undated

EVEN, ODD = "o_orderkey % 2 = 0", "o_orderkey % 2 = 1"


def _load(spark, folder, condition=None):
    raw = {name: table(spark, folder, name) for name in ("orders", "lineitem", "customer")}
    if condition:
        raw["orders"] = raw["orders"].where(condition)
        raw["lineitem"] = raw["lineitem"].where(condition.replace("o_", "l_"))
    return raw


@query("medallion_two_loads", SQL["medallion_revenue"])
def medallion_two_loads(spark, folder):
    """Half of the orders today, the other half tomorrow, then the first half again."""
    lake = Lake(scratch(spark, "lake"))
    run_medallion(spark, _load(spark, folder, EVEN), lake, "2024-04-01")
    run_medallion(spark, _load(spark, folder, ODD), lake, "2024-04-02")
    run_medallion(spark, _load(spark, folder, EVEN), lake, "2024-04-03")
    return read_monthly(spark, lake)


@query("backfill_partial_month", SQL["medallion_revenue"])
def backfill_partial_month(spark, folder):
    lake = Lake(scratch(spark, "lake"))
    run_medallion(spark, _load(spark, folder), lake, "2024-04-01")
    backfill(spark, lake, "1997-03-15", "1997-04-10")
    return read_monthly(spark, lake)


@query(
    "emptied_partitions_go",
    "select o_orderkey, o_orderpriority from orders where o_orderpriority is distinct from '1-URGENT'",
)
def emptied_partitions_go(spark, folder):
    path = scratch(spark, "emptied")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    replace_partitions(orders, path, ["o_orderpriority"])
    left = orders.where("not o_orderpriority <=> '1-URGENT'")
    replace_partitions(left, path, ["o_orderpriority"], covers=F.lit(True))
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority")


@query(
    "merge_null_partition",
    """select o_orderkey, case when o_orderkey % 3 = 0 then -1.0 else o_totalprice end as o_totalprice,
              nullif(o_orderstatus, 'P') as part from orders""",
)
def merge_null_partition(spark, folder):
    path = scratch(spark, "merge")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.expr("nullif(o_orderstatus, 'P')").alias("part")
    )
    replace_partitions(orders, path, ["part"])
    changed = orders.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(-1.0))
    merge_partitions(spark, path, changed, ["o_orderkey"], "part")
    return spark.read.parquet(path)


@query(
    "upsert_null_key",
    """with keyed as (select nullif(n_regionkey, 0) as k, max(n_nationkey) as v from nation group by 1)
       select k, v + 100 as v from keyed""",
)
def upsert_null_key(spark, folder):
    nation = table(spark, folder, "nation")
    target = nation.groupBy(F.expr("nullif(n_regionkey, 0)").alias("k")).agg(F.max("n_nationkey").alias("v"))
    source = target.withColumn("v", F.col("v") + 100)
    once = upsert(target, source, ["k"])
    return upsert(once, source, ["k"])


@query(
    "cdc_null_op",
    """with coded as (select o_custkey, o_totalprice, o_orderstatus, row_number() over (partition by o_custkey
              order by o_orderdate desc, o_orderkey desc) as rn from orders where o_orderstatus <> 'P'),
            last as (select * from coded where rn = 1)
       select c_custkey, c_acctbal from customer where c_custkey not in (select o_custkey from last where o_custkey is not null)
       union all select o_custkey, o_totalprice from last where o_orderstatus <> 'F'""",
)
def cdc_null_op(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    changes = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        "o_orderdate",
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "O", "U").alias("op"),
    )
    return cdc_apply(customer, changes, ["c_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "incremental_ties",
    """select o_orderkey, o_orderdate, o_orderdate is null as undated from
       (select o_orderkey, case when o_orderkey % 7 = 0 then null else o_orderdate end as o_orderdate from orders)""",
)
def incremental_ties(spark, folder):
    """Half of the rows of the newest day come late, and some have no day at all: none is lost or doubled."""
    dated = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    orders = table(spark, folder, "orders").select("o_orderkey", dated.alias("o_orderdate"))
    mark = HighWaterMark(spark, scratch(spark, "mark"))
    middle = orders.agg(F.percentile_approx("o_orderdate", 0.5)).first()[0]
    early = (F.col("o_orderdate") < F.lit(middle)) | ((F.col("o_orderdate") == F.lit(middle)) & (F.col("o_orderkey") % 2 == 0))
    first = mark.read(orders.where(early), "o_orderdate", orders.limit(0), ["o_orderkey"])
    mark.commit(first, "o_orderdate")
    rest = mark.read(orders, "o_orderdate", first, ["o_orderkey"])
    found = first.union(rest).withColumn("undated", F.lit(False))
    return found.union(undated(orders, "o_orderdate").withColumn("undated", F.lit(True)))


@query("encoding_utf8", "select doc_id, text as from_utf8, text as from_utf16, length(text) as characters from documents")
def encoding_utf8(spark, folder):
    """Texts written in two encodings come back as they were."""
    from tidemark.functions.encoding import to_utf8

    raw = table(spark, folder, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("utf8"), F.encode("text", "UTF-16LE").alias("utf16")
    )
    text = raw.select("doc_id", to_utf8(F.col("utf8")).alias("from_utf8"), to_utf8(F.col("utf16"), "UTF-16LE").alias("from_utf16"))
    return text.withColumn("characters", F.length("from_utf8").cast("long"))


@query(
    "schema_enforced_append",
    """select o_orderpriority as part, count(*) as n, sum(o_orderkey)::bigint as keys from orders group by 1""",
)
def schema_enforced_append(spark, folder):
    """Batches of orders, of which those with another schema are refused, whole and without a trace."""
    from tidemark.sinks.batch import SchemaMismatch, append_enforced

    path = scratch(spark, "enforced")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("part"))
    bad = [orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string")), orders.withColumn("more", F.lit(1)), orders.select("part")]
    for rest in range(3):
        append_enforced(orders.where(F.col("o_orderkey") % 3 == rest), path, partition_by=["part"])
        try:
            append_enforced(bad[rest], path, partition_by=["part"])
        except SchemaMismatch:
            continue
        raise AssertionError("a batch of another schema was taken")
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("part").cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "schema_history",
    """select * from (values (1, 'user_id', 'added', null, 'bigint'), (2, 'value', 'retyped', 'bigint', 'double'))
       as t(version, column_name, change, old_type, new_type) where (select count(*) from events) > 0""",
)
def schema_history(spark, folder):
    """What the log of an ingest says after three arrivals of events."""
    from tidemark.queries.ingest import drain, ingester

    root = scratch(spark, "history")
    events = table(spark, folder, "events")
    whole = F.floor("value").alias("value")
    arrivals = [events.select("event_id", whole), events.select("event_id", whole, "user_id"), events.select("event_id", "value", "user_id")]
    for number, rows in enumerate(arrivals):
        rows.write.json(f"{root}/in/{number}")
        ingest = ingester(spark, root, "json")
        drain(ingest, root)
    return ingest.log.history().where("version > 0")


@query(
    "returns_by_region",
    """select n_name as region, l_shipmode_kind as return_reason, count(*) as returns, sum(l_quantity)::bigint as returned_qty,
              sum(l_extendedprice::decimal(18,2))::double as refund_total
       from (select *, case when l_linenumber % 2 = 0 then 'even' else 'odd' end as l_shipmode_kind from lineitem where l_returnflag = 'R')
            join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2""",
)
def returns_by_region(spark, folder):
    """Returned lines as facts; ship days, suppliers and parts as their dimensions."""
    from tidemark.operators.marts import returns_analysis

    lines = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    reason = F.when(F.col("l_linenumber") % 2 == 0, "even").otherwise("odd")
    returns = lines.select(
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("date_sk"), F.col("l_suppkey").alias("store_sk"),
        F.col("l_partkey").alias("product_sk"), F.col("l_quantity").cast("long").alias("returned_qty"),
        F.col("l_extendedprice").alias("refund_amount"), reason.alias("return_reason"),
    )
    dates = returns.select("date_sk").distinct().withColumn("month", F.floor(F.col("date_sk") / 100))
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("store_sk"), "s_nationkey")
    stores = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select("store_sk", "region")
    products = table(spark, folder, "part").select(F.col("p_partkey").alias("product_sk"))
    return returns_analysis(returns, dates, stores, products, ["region", "return_reason"])


@query(
    "file_ingest_run",
    """select event_type, count(*) as n, sum(event_id)::bigint as ids from events group by 1""",
)
def file_ingest_run(spark, folder):
    """The ingest job as the command line runs it: files to a catalog table, twice, the second time with more files."""
    from tidemark.plans.file_ingest import run_file_ingest
    from tidemark.queries.ingest import ingester
    from tidemark.session import unique_name

    root, name = scratch(spark, "ingest-run"), unique_name("ingest_run")
    events = table(spark, folder, "events").select("event_id", "event_type")
    for rest in range(2):
        events.where(F.col("event_id") % 2 == rest).write.json(f"{root}/in/{rest}")
        run_file_ingest(spark, ingester(spark, root, "json").config, name)
    return spark.table(name).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
