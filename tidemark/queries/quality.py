"""Data-quality metrics, scores and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.cleanse import first_per_key
from tidemark.queries import query
from tidemark.session import scratch, table
from tidemark.sinks import paths

# A workable set of faults: the tables have no NULL, so long props, errors and
# expensive orders are declared bad here and in the SQL alike.
ORDER_RULES = [
    dq.required("o_custkey"),
    dq.in_range("o_totalprice", 1000, 450000),
    dq.one_of("o_orderstatus", ["F", "O"]),
    dq.matches("o_orderpriority", "^[1-4]-"),
]
ORDER_CODES_SQL = """
case when o_custkey is null then 'missing:o_custkey' end,
case when not (o_totalprice >= 1000 and o_totalprice <= 450000) then 'range:o_totalprice' end,
case when o_orderstatus not in ('F', 'O') then 'domain:o_orderstatus' end,
case when not regexp_matches(o_orderpriority, '^[1-4]-') then 'pattern:o_orderpriority' end
"""
TAGGED_SQL = f"(select *, list_filter([{ORDER_CODES_SQL}], lambda x: x is not null) as codes from orders)"


def orders(spark, folder):
    return table(spark, folder, "orders")


def maybe_null_orders(spark, folder):
    """Orders with NULL where the order is pending or the priority is low."""
    return orders(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
    )


MAYBE_NULL_SQL = """(select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as o_custkey,
       case when o_orderpriority <> '5-LOW' then o_totalprice end as o_totalprice from orders)"""
NULLABLE = ("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "remove_invalid",
    f"select o_orderkey, o_totalprice, o_orderstatus from {TAGGED_SQL} where len(codes) = 0",
)
def remove_invalid(spark, folder):
    return dq.remove_invalid(orders(spark, folder), ORDER_RULES).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "quarantine_rows",
    f"""select o_orderkey, array_to_string(codes, ',') as error_codes from {TAGGED_SQL} where len(codes) > 0""",
)
def quarantine_rows(spark, folder):
    path = scratch(spark, "checked-orders")
    dq.write_checked(orders(spark, folder), ORDER_RULES, path)
    return dq.read_quarantined(spark, path).select(
        "o_orderkey", F.array_join("_errors", ",").alias("error_codes")
    )


@query(
    "dq_type_mismatch",
    """select 'o_orderpriority' as column_name, count(*) as row_count,
              count(*) filter (o_orderpriority is not null and try_cast(o_orderpriority as integer) is null) as mismatch_count from orders
       union all
       select 'o_orderstatus', count(*), count(*) filter (o_orderstatus is not null and try_cast(o_orderstatus as double) is null) from orders""",
)
def dq_type_mismatch(spark, folder):
    return dq.type_mismatches(orders(spark, folder), {"o_orderpriority": "int", "o_orderstatus": "double"})


@query(
    "dq_null_pct",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as row_count, count(*) filter ({c} is null) as null_count,
            round((count(*) filter ({c} is null))::double * 100 / count(*)::double, 9) as null_pct from {MAYBE_NULL_SQL}"""
        for c in NULLABLE
    ),
)
def dq_null_pct(spark, folder):
    return dq.null_profile(maybe_null_orders(spark, folder)).withColumn("null_pct", F.round("null_pct", 9))


@query(
    "dq_completeness",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as row_count, count({c}) as present_count,
            round(count({c})::double * 100 / count(*)::double, 9) as completeness_pct from {MAYBE_NULL_SQL}"""
        for c in NULLABLE
    ),
)
def dq_completeness(spark, folder):
    return dq.completeness(maybe_null_orders(spark, folder), NULLABLE).withColumn(
        "completeness_pct", F.round("completeness_pct", 9)
    )


ACCURACY_RULES = [
    dq.in_range("l_discount", 0, 0.08),
    dq.in_range("l_quantity", 1, 45),
    dq.matches("l_returnflag", "^[AN]$"),
]


@query(
    "dq_accuracy",
    """with f as (select count(*) as row_count,
                  count(*) filter (not (l_discount >= 0 and l_discount <= 0.08)) as a,
                  count(*) filter (not (l_quantity >= 1 and l_quantity <= 45)) as b,
                  count(*) filter (not regexp_matches(l_returnflag, '^[AN]$')) as c from lineitem),
       r as (select row_count, 'range:l_discount' as rule, a as failed_count from f
             union all select row_count, 'range:l_quantity', b from f
             union all select row_count, 'pattern:l_returnflag', c from f)
       select *, round((row_count - failed_count)::double * 100 / row_count::double, 9) as pass_pct from r""",
)
def dq_accuracy(spark, folder):
    return dq.rule_metrics(table(spark, folder, "lineitem"), ACCURACY_RULES).withColumn(
        "pass_pct", F.round("pass_pct", 9)
    )


@query(
    "dq_duplicates",
    """select l_orderkey, l_linenumber, count(*) as copies from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def dq_duplicates(spark, folder):
    return dq.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_uniqueness",
    """select count(*) as row_count, count(distinct (l_orderkey, l_linenumber)) as distinct_keys,
              count(*) - count(distinct (l_orderkey, l_linenumber)) as violations from lineitem""",
)
def dq_uniqueness(spark, folder):
    return dq.uniqueness(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        F.col("row_count").cast("bigint").alias("row_count"),
        "distinct_keys",
        F.col("violations").cast("bigint").alias("violations"),
    )


@query(
    "dedup_keep_first",
    """select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber
          order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn
       from lineitem) where rn = 1""",
)
def dedup_keep_first(spark, folder):
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    return first_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@query(
    "dq_referential",
    """select o_custkey, count(*) as orphan_rows from orders
       where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_acctbal >= 0)
       group by o_custkey""",
)
def dq_referential(spark, folder):
    solvent = table(spark, folder, "customer").where("c_acctbal >= 0")
    return dq.referential(orders(spark, folder), solvent, "o_custkey", "c_custkey")


@query(
    "dq_freshness",
    """with a as (select event_type, max(ts) as latest from events where not (event_type = 'signup' and ts > timestamp '2024-01-29')
                  group by event_type),
            b as (select *, (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(latest)) / 1e6 / 3600.0 as age_hours from a)
       select event_type, latest, round(age_hours, 9) as age_hours,
              case when age_hours <= 0.1 then 'green' when age_hours <= 24 then 'yellow' else 'red' end as status from b""",
)
def dq_freshness(spark, folder):
    stale = "not (event_type = 'signup' and ts > timestamp_ntz'2024-01-29')"
    events = table(spark, folder, "events").where(stale)
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    found = dq.freshness(events, "ts", as_of, sla_hours=0.1, by=["event_type"])
    return found.select(
        "event_type",
        F.col("latest").cast("timestamp_ntz").alias("latest"),
        F.round("age_hours", 9).alias("age_hours"),
        "status",
    )


@query(
    "dq_row_count",
    "select count(*) as row_count, count(*) >= 1000 as in_bounds from lineitem",
)
def dq_row_count(spark, folder):
    return dq.row_count_check(table(spark, folder, "lineitem"), low=1000)


@query(
    "dq_ingest_metrics",
    f"""select o_orderpriority, count(*) as ingested, count(*) filter (len(codes) = 0) as accepted,
               count(*) filter (len(codes) > 0) as rejected from {TAGGED_SQL} group by o_orderpriority""",
)
def dq_ingest_metrics(spark, folder):
    return dq.ingest_metrics(orders(spark, folder), ORDER_RULES, ["o_orderpriority"])


@query(
    "dq_score",
    f"""select count(*) as total_rows, count(*) filter (len(codes) = 0) as valid_rows,
               round((count(*) filter (len(codes) = 0))::double * 100 / count(*)::double, 9) as score,
               (count(*) filter (len(codes) = 0))::double * 100 / count(*)::double > 99 as meets_target from {TAGGED_SQL}""",
)
def dq_score(spark, folder):
    return dq.quality_score(orders(spark, folder), ORDER_RULES).withColumn("score", F.round("score", 9))


@query(
    "dq_scorecard",
    f"""with s as (select date_trunc('month', o_orderdate)::timestamp as period, count(*) as total_rows,
                          count(*) filter (len(codes) = 0) as valid_rows from {TAGGED_SQL} group by 1),
            t as (select *, valid_rows::double * 100 / total_rows::double as score from s),
            l as (select *, lag(score) over (order by period) as previous_score from t)
       select period, total_rows, valid_rows, round(score, 9) as score, score > 99 as meets_target,
              round(previous_score, 9) as previous_score, round(score - previous_score, 9) as trend from l""",
)
def dq_scorecard(spark, folder):
    dated = orders(spark, folder).withColumn("period", F.date_trunc("month", F.col("o_orderdate").cast("timestamp")))
    card = dq.scorecard(dated, ORDER_RULES, "period")
    return card.select(
        F.col("period").cast("timestamp_ntz").alias("period"),
        "total_rows",
        "valid_rows",
        "meets_target",
        *[F.round(c, 9).alias(c) for c in ("score", "previous_score", "trend")],
    )


@query(
    "dq_file_integrity",
    """select cast(year(l_shipdate) as integer) as year, count(*) as expected_rows,
              count(case when year(l_shipdate) <> 1997 or l_linenumber <> 1 then 1 end) as row_count,
              cast(case when year(l_shipdate) = 1996 then 1 else 0 end as bigint) as empty_files,
              year(l_shipdate) not in (1996, 1997) as sound
       from lineitem group by year(l_shipdate)""",
)
def dq_file_integrity(spark, folder):
    """Files of a delivery against its manifest: one year has an empty file, another lacks rows."""
    path = scratch(spark, "delivery")
    lines = table(spark, folder, "lineitem").select("l_linenumber", F.year("l_shipdate").alias("year"))
    manifest = lines.groupBy("year").agg(F.count(F.lit(1)).alias("expected_rows"))
    lines.where("year <> 1997 or l_linenumber <> 1").write.partitionBy("year").parquet(path)
    paths.write_once(spark, f"{path}/year=1996/part-empty.parquet", "")
    delivered = spark.read.schema("l_linenumber bigint, year int").parquet(path)
    files = dq.folder_integrity(spark, path, delivered)
    files = files.withColumn("year", F.regexp_extract("file_path", "/year=([0-9]+)/", 1).cast("int"))
    found = files.groupBy("year").agg(
        F.sum("row_count").alias("row_count"), F.count_if(F.col("file_size") == 0).alias("empty_files")
    )
    checked = manifest.join(found, "year", "left").fillna(0, ["row_count", "empty_files"])
    return checked.withColumn("sound", (F.col("row_count") == F.col("expected_rows")) & (F.col("empty_files") == 0))
