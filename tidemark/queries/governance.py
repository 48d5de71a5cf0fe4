"""Masking and access policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.masking import EMAIL, SSN, mask_for_role, mask_pii, tokenize
from tidemark.operators.access import columns_for_role, reachable, rows_for_role
from tidemark.operators.sizing import small_side
from tidemark.plans.medallion import Lake, run_medallion
from tidemark.queries import query
from tidemark.session import scratch, table


@query(
    "mask_pii",
    f"""select doc_id, regexp_replace(regexp_replace(text, '{EMAIL}', '***@***.com', 'g'), '{SSN}', '***-**-***', 'g') as masked
       from documents""",
)
def mask_pii_query(spark, folder):
    return table(spark, folder, "documents").select("doc_id", mask_pii(F.col("text")).alias("masked"))


@query("tokenize", "select c_custkey, sha256('pepper' || c_name) as name_token from customer")
def tokenize_query(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", tokenize(F.col("c_name"), "pepper").alias("name_token"))


@query(
    "mask_by_role",
    """select conv_id, turn, caller, case when caller in ('steward', 'auditor') then text else '***' end as text_shown
       from conversations, (values ('steward'), ('analyst')) as callers(caller)""",
)
def mask_by_role(spark, folder):
    """What two callers see, each with their own role."""

    def seen_by(caller):
        shown = mask_for_role(F.col("text"), caller, ["steward", "auditor"], F.lit("***"))
        return table(spark, folder, "conversations").select("conv_id", "turn", F.lit(caller).alias("caller"), shown.alias("text_shown"))

    return seen_by("steward").unionByName(seen_by("analyst"))


@query(
    "rls_filtered",
    """select c_custkey, c_nationkey, c_acctbal from customer
       where c_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA')""",
)
def rls_filtered(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    policy = nation.join(small_side(region), nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("r_name").alias("role"), F.col("n_nationkey").alias("attribute")
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return rows_for_role(customer, policy, "ASIA", "c_nationkey")


@query("column_security", "select c_custkey, c_nationkey, c_mktsegment from customer")
def column_security(spark, folder):
    granted = [("analyst", c) for c in ("c_custkey", "c_nationkey", "c_mktsegment")]
    granted += [("owner", c) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    policy = spark.createDataFrame(granted, "role string, column_name string")
    return columns_for_role(table(spark, folder, "customer"), policy, "analyst")


@query(
    "lineage_impact",
    """select n_name as "table", 1 as distance from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA'
       union all
       select s_name, 2 from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
       where r_name = 'ASIA'""",
)
def lineage_impact(spark, folder):
    """Everything upstream of one region, over edges supplier -> nation -> region."""
    nation, region, supplier = (table(spark, folder, n) for n in ("nation", "region", "supplier"))
    to_region = nation.join(small_side(region), nation["n_regionkey"] == region["r_regionkey"])
    to_nation = supplier.join(small_side(nation), supplier["s_nationkey"] == nation["n_nationkey"])
    edges = to_region.select(F.col("n_name").alias("source"), F.col("r_name").alias("target")).unionByName(
        to_nation.select(F.col("s_name").alias("source"), F.col("n_name").alias("target"))
    )
    return reachable(edges, "ASIA", upstream=True)


@query(
    "erase_subject_everywhere",
    """with gone as (select c_custkey from customer where c_custkey % 50 = 0),
            gone_orders as (select o_orderkey, o_orderdate from orders where o_custkey in (select c_custkey from gone)),
            gone_lines as (select l_orderkey, l_linenumber from lineitem join gone_orders on l_orderkey = o_orderkey),
            kept_lines as (select distinct l_orderkey, l_linenumber from gone_lines)
       select 'bronze' as layer, 'customer' as "table", (select count(*) from gone) as rows_erased, 0::bigint as rows_left
       union all select 'bronze', 'orders', (select count(*) from gone_orders), 0
       union all select 'bronze', 'lineitem', (select count(*) from gone_lines), 0
       union all select 'quarantine', 'customer', 0, 0 union all select 'quarantine', 'lineitem', 0, 0
       union all select 'quarantine', 'orders', (select count(*) from gone_orders where o_orderkey % 400 = 0), 0
       union all select 'silver', 'customer', (select count(*) from gone), 0
       union all select 'silver', 'orders', (select count(*) from gone_orders where o_orderkey % 400 <> 0), 0
       union all select 'silver', 'lineitem', (select count(*) from kept_lines), 0
       union all select 'gold', 'fact_sales', (select count(*) from kept_lines where l_orderkey % 400 <> 0), 0
       union all select 'gold', 'fact_revenue_monthly', 0, 0""",
)
def erase_subject_everywhere(spark, folder):
    """Some customers, with their orders, lines and sales, from a lake that has some of their orders in quarantine."""
    from tidemark.plans.erasure import erase_everywhere

    lake = Lake(scratch(spark, "erasure"))
    raw = {name: table(spark, folder, name) for name in ("orders", "lineitem", "customer")}
    raw["orders"] = raw["orders"].withColumn("o_orderdate", F.when(F.col("o_orderkey") % 400 != 0, F.col("o_orderdate")))
    run_medallion(spark, raw, lake, "2024-04-01")
    subjects = raw["customer"].where("c_custkey % 50 = 0").select("c_custkey")
    return erase_everywhere(spark, lake, subjects).drop("parts_rewritten")
