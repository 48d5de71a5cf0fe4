"""Bronze, silver and gold tables from raw orders, lines and customers.

Loads land in bronze by date. A load is checked as it is: rows that break a rule, a
missing key among them, go to its quarantine, and a load with too small a share of
good rows stops before anything of it can be read. Good rows are merged into silver,
which lies in parts by key hash: only the parts of a load's keys are rewritten, as a
new version, and a pointer file moves readers of all silver tables to it at once. Gold
is rebuilt for the months that differ between the two versions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.cleanse import fill_defaults
from tidemark.operators.joins import Dimension, star_join
from tidemark.operators.marts import monthly_revenue
from tidemark.operators.sizing import measured_bytes
from tidemark.session import scratch, size_shuffles, table, together
from tidemark.sinks import paths
from tidemark.sinks.batch import by_month, land, replace_partitions
from tidemark.sinks.parts import PLACE, PartTable, Pointer

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_RULES = [
    dq.required("l_orderkey"),
    dq.required("l_linenumber"),
    dq.required("l_partkey"),
    dq.in_range("l_quantity", 0),
    dq.in_range("l_extendedprice", 0),
    dq.in_range("l_discount", 0, 1),
]
ORDER_RULES = [dq.required("o_orderkey"), dq.required("o_custkey"), dq.required("o_orderdate")]
CUSTOMER_RULES = [dq.required("c_custkey")]
PARTITION = ["year", "month"]
# Share of good rows that a load must have.
LEAST_GOOD = 0.99
# Columns of silver: the load that a row is from, and the version that last changed it.
LOAD, VERSION = "_load_date", "_version"


@dataclass(frozen=True)
class Silver:
    """How a table is kept in silver: its key, what its parts hash, its rules, and which of equal keys in a load stays."""

    keys: Sequence[str]
    part_keys: Sequence[str]
    rules: Sequence[dq.Rule]
    order: Sequence[str]
    defaults: Mapping[str, object] = field(default_factory=dict)


SILVER = {
    "orders": Silver(["o_orderkey"], ["o_orderkey"], ORDER_RULES, ["o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]),
    "lineitem": Silver(LINE_KEY, ["l_orderkey"], LINE_RULES, LINE_ORDER, {"l_discount": 0.0, "l_tax": 0.0}),
    "customer": Silver(["c_custkey"], ["c_custkey"], CUSTOMER_RULES, ["c_name"]),
}


@dataclass(frozen=True)
class Lake:
    """Where each layer lives; ``parts`` fixes the number of silver parts, which else follows the first load."""

    root: str
    parts: int | None = None

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def checked(self, name: str, load_date: str) -> str:
        return f"{self.root}/checked/{name}/load_date={load_date}"

    def silver(self, spark: SparkSession, name: str) -> PartTable:
        return PartTable(spark, f"{self.root}/silver/{name}", SILVER[name].part_keys, self.parts)

    def pointer(self, spark: SparkSession) -> Pointer:
        return Pointer(spark, f"{self.root}/silver/published.json")

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def to_bronze(raw: dict[str, DataFrame], lake: Lake, load_date: str, source_system: str) -> None:
    together(*[partial(land, df, lake.bronze(name), load_date, source_system) for name, df in raw.items()])


def _landed(spark: SparkSession, lake: Lake, name: str, loads: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(lake.bronze(name)).where(F.col("load_date").cast("string").isin(list(loads)))
    rows = rows.withColumn(LOAD, F.col("load_date").cast("string")).drop("load_date", "source_system")
    return fill_defaults(rows, SILVER[name].defaults)


def check_load(spark: SparkSession, lake: Lake, load_date: str, least_good: float = LEAST_GOOD, min_rows: int = 1) -> None:
    """Write the bad rows of a load apart, and stop if too few are good.

    The score is the share of good rows among all rows that were checked, table by
    table. A load that fails has changed nothing that readers of silver or gold
    see; its bad rows and their codes stay in ``quarantined``.
    """
    for name in SILVER:
        if min_rows and not paths.exists(spark, f"{lake.bronze(name)}/load_date={load_date}"):
            raise dq.QualityError(f"{name}: 0 rows, at least {min_rows} required")
    counts: dict[str, tuple[int, int]] = {}

    def check(name: str) -> None:
        counts[name] = dq.write_quarantined(_landed(spark, lake, name, [load_date]), SILVER[name].rules, lake.checked(name, load_date))

    together(*[partial(check, name) for name in SILVER])
    for name in SILVER:
        dq.assert_good(*counts[name], least_good, min_rows, name)


def quarantined(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Bad rows of all loads with the codes of the rules they break; silver's columns and no row if there are none."""
    if not paths.holds_data(spark, f"{lake.root}/checked/{name}"):
        return read_silver(spark, lake, name).limit(0).withColumn("_errors", F.array().cast("array<string>"))
    rows = spark.read.option("basePath", f"{lake.root}/checked/{name}").parquet(f"{lake.root}/checked/{name}")
    return rows.where("checked = 'quarantined'").drop("checked", "load_date")


def _both(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Rows of silver and of loads together, told apart by ``_new``."""
    new = new.withColumn("_new", F.lit(True))
    if old is None:
        return new.withColumn(VERSION, F.lit(None).cast("long"))
    return old.withColumn("_new", F.lit(False)).unionByName(new, allowMissingColumns=True)


def _newest(both: DataFrame, columns: Sequence[str], kept: Silver, version: int, again: str | None = None) -> DataFrame:
    """One row per key of what was placed: that of the newest load, a new one at a tie, of these the first by ``kept.order``.

    ``VERSION`` moves only where a value differs. Rows that silver has of the load
    ``again`` count for that, but do not stay. One sort answers it all.
    """
    values = [c for c in columns if c not in (*kept.keys, LOAD)]
    out = ~F.col("_new") & (F.col(LOAD) == again) if again else F.lit(False)
    key = Window.partitionBy(*PLACE, *kept.keys).orderBy(F.col("_out"), F.desc(LOAD), F.desc("_new"), *kept.order)
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = both.withColumn("_out", out).withColumns({
        "_rn": F.row_number().over(key),
        "_stood": F.max(F.when(~F.col("_new"), F.struct(VERSION, *values))).over(whole),
    })
    last = ranked.where("_rn = 1 and not _out")
    same = F.col("_stood").isNotNull()
    for value in values:
        same &= F.col(value).eqNullSafe(F.col(f"_stood.{value}"))
    moved = F.when(same, F.col(f"_stood.{VERSION}")).otherwise(F.lit(version)).cast("long")
    return last.select(*kept.keys, *values, LOAD, moved.alias(VERSION), *PLACE)


def to_silver(spark: SparkSession, lake: Lake, load_date: str) -> dict[str, int]:
    """Merge the good rows of a checked load into silver; returns the versions written, which nobody reads yet.

    A key keeps the row of its newest load. Loads may come late. One that was
    merged before is taken back first: its rows leave the parts they are in, and what
    retained bronze has of other merged loads for these parts takes their place. Rows
    are shuffled once, to where they are stored.
    """
    published = lake.pointer(spark).get()
    versions: dict[str, int] = {}

    def merge(name: str) -> None:
        kept, silver = SILVER[name], lake.silver(spark, name)
        before = silver.manifest(published[name]) if name in published else None
        version = before.version + 1 if before else 0
        loads = list(before.notes["loads"]) if before else []
        good = dq.remove_invalid(_landed(spark, lake, name, [load_date]), kept.rules)
        new, also, again = good, [], None
        if load_date in loads:
            again = load_date
            taken = silver.read(before.version).where(F.col(LOAD) == load_date)
            also = sorted({*silver.touched(taken, before.parts), *silver.touched(good, before.parts)})
            others = _landed(spark, lake, name, [x for x in loads if x != load_date])
            others = dq.remove_invalid(others, kept.rules).where(silver.part(before.parts).isin(also))
            new = good.unionByName(others, allowMissingColumns=True)
        settle = partial(_newest, columns=new.columns, kept=kept, version=version, again=again)
        notes = {"loads": sorted({*loads, load_date})}
        if before is None:
            silver.write(_both(None, new), version, notes, settle)
        else:
            silver.merge(new, _both, version, notes, also, settle)
        versions[name] = version

    together(*[partial(merge, name) for name in SILVER])
    return versions


def publish(spark: SparkSession, lake: Lake, versions: Mapping[str, int]) -> None:
    """Move readers of all silver tables to these versions at once."""
    lake.pointer(spark).set(versions)


def read_silver(spark: SparkSession, lake: Lake, name: str, versions: Mapping[str, int] | None = None) -> DataFrame:
    """A silver table as published, or of the given versions."""
    versions = versions if versions is not None else lake.pointer(spark).get()
    return lake.silver(spark, name).read(versions[name]).drop(LOAD, VERSION)


def changed_months(spark: SparkSession, lake: Lake, before: Mapping[str, int], after: Mapping[str, int]) -> list[int]:
    """Months (year * 12 + month - 1) whose facts differ between two silver versions.

    An order counts with its old and its new date when it, one of its lines, or
    the segment of its customer is new, changed or gone.
    """

    def rewritten(name: str) -> list[DataFrame]:
        """A table before and after, of the parts that were rewritten: only these can have changed or lost a row."""
        silver = lake.silver(spark, name)
        links = [silver.manifest(v) for v in (before[name], after[name])]
        if links[0].parts != links[1].parts:
            return [silver.read(link.version) for link in links]
        parts = [p for p in range(links[0].parts) if links[0].folders.get(p) != links[1].folders.get(p)]
        return [silver.read(link.version, parts) for link in links]

    def differing(name: str, keys: Sequence[str]) -> DataFrame:
        old, new = rewritten(name)
        changed = new.where(F.col(VERSION) == after[name]).select(*keys)
        return changed.union(old.join(new, list(keys), "left_anti").select(*keys)).distinct()

    orders, lines = differing("orders", ["o_orderkey"]), differing("lineitem", ["l_orderkey", "l_linenumber"])
    # One join by key. Unions of joined customers look dealt by key to Spark 4.1, which then leaves out a
    # shuffle and finds their numbers of partitions unequal when it runs, unless they are broadcast.
    sides = [df.select("c_custkey", F.struct("c_mktsegment").alias(side)) for df, side in zip(rewritten("customer"), ("_was", "_is"), strict=True)]
    moved = sides[0].join(sides[1], "c_custkey", "full_outer").where(~F.col("_was").eqNullSafe(F.col("_is"))).select("c_custkey")
    dated = [lake.silver(spark, "orders").read(v["orders"]).select("o_orderkey", "o_custkey", "o_orderdate") for v in (before, after)]
    every = dated[0].union(dated[1])
    touched = orders.union(lines.select("l_orderkey")).distinct()
    dates = every.join(touched, "o_orderkey", "left_semi").union(
        every.join(moved.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left_semi").select(every.columns)
    )
    number = F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1
    return sorted(r[0] for r in dates.select(number).distinct().collect())


def sales_lines(spark: SparkSession, lake: Lake, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row per order line with its net amount, for order dates in ``[first, last)``."""
    orders = read_silver(spark, lake, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if first:
        orders = orders.where(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
    if last:
        orders = orders.where(F.col("o_orderdate") < F.lit(last).cast("timestamp_ntz"))
    customers = read_silver(spark, lake, "customer").select("c_custkey", "c_mktsegment")
    orders = star_join(orders, [Dimension(customers, "o_custkey", "c_custkey")])
    price, discount = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    lines = read_silver(spark, lake, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", (price * (1 - discount)).alias("amount")
    )
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def whole_months(first: str | None, last: str | None) -> tuple[str | None, str | None]:
    """``[first, last)`` widened to months: from the first day of one to the first day of another."""
    if first:
        first = f"{first[:7]}-01"
    if last and last[8:10] not in ("", "01"):
        month = int(last[:4]) * 12 + int(last[5:7])
        last = f"{month // 12:04d}-{month % 12 + 1:02d}-01"
    return first, last


def to_gold(spark: SparkSession, lake: Lake, first: str | None = None, last: str | None = None, months: Sequence[int] | None = None) -> None:
    """Write sales facts by month, then the monthly mart from the facts just written.

    With a date range, or ``months`` (year * 12 + month - 1), only these months are
    replaced, so a backfill can be repeated. A range is widened to whole months,
    since a partition is replaced as a whole, and months of it that have no rows
    left are removed. The mart has a few rows a month and is partitioned by year;
    the years of these months are rebuilt.
    """
    if months is not None:
        if not months:
            return
        first, last = (f"{m // 12:04d}-{m % 12 + 1:02d}-01" for m in (min(months), max(months) + 1))
    first, last = whole_months(first, last)
    number = F.col("year") * 12 + F.col("month") - 1
    covers, years = F.lit(True), F.lit(True)
    if first:
        covers &= number >= int(first[:4]) * 12 + int(first[5:7]) - 1
        years &= F.col("year") >= int(first[:4])
    if last:
        end = int(last[:4]) * 12 + int(last[5:7]) - 1
        covers &= number < end
        years &= F.col("year") <= (end - 1) // 12
    if months is not None:
        covers &= number.isin(list(months))
        years &= F.col("year").isin(sorted({m // 12 for m in months}))
    facts = by_month(sales_lines(spark, lake, first, last), "o_orderdate").where(covers).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("o_orderdate").alias("order_date"),
        "amount",
        F.col("l_quantity").alias("quantity"),
        *PARTITION,
    )
    replace_partitions(facts, lake.gold("fact_sales"), PARTITION, covers=covers)
    stored = spark.read.parquet(lake.gold("fact_sales"))
    monthly = monthly_revenue(stored.where(years), "order_date", "customer_segment", "amount", "order_id")
    mart = monthly.withColumn("year", F.year("month"))
    replace_partitions(mart, lake.gold("fact_revenue_monthly"), ["year"], covers=years)


def run_medallion(
    spark: SparkSession, raw: dict[str, DataFrame], lake: Lake, load_date: str, source_system: str = "erp",
    least_good: float = LEAST_GOOD,
) -> list[int] | None:
    """Land, check, merge and publish one load; returns the months of gold that it changed, None for all.

    The months are written down before readers move to the new versions, so a run
    that stops between silver and gold is finished by the next one.
    """
    to_bronze(raw, lake, load_date, source_system)
    check_load(spark, lake, load_date, least_good)
    before = lake.pointer(spark).get()
    size_shuffles(spark, _moved_bytes(spark, lake, load_date, before))
    after = to_silver(spark, lake, load_date)
    months = changed_months(spark, lake, before, after) if before else None
    due = _due(spark, lake)
    due = None if months is None or due is None else sorted({*months, *due})
    paths.put(spark, f"{lake.root}/silver/due.json", json.dumps({"months": due}))
    publish(spark, lake, after)
    to_gold(spark, lake, months=due)
    paths.put(spark, f"{lake.root}/silver/due.json", json.dumps({"months": []}))
    return due


def _moved_bytes(spark: SparkSession, lake: Lake, load_date: str, before: Mapping[str, int]) -> int:
    """Bytes in memory of a load and of the silver tables, as if these were packed like the load."""
    total = 0
    for name in SILVER:
        folder = f"{lake.bronze(name)}/load_date={load_date}"
        packed = max(1, paths.total_bytes(spark, folder))
        stands = lake.silver(spark, name).bytes(before[name]) if name in before else 0
        total += round(measured_bytes(spark.read.parquet(folder)) * (1 + stands / packed))
    return total


def _due(spark: SparkSession, lake: Lake) -> list[int] | None:
    """Months of gold that an earlier run has left to do; None for all."""
    file = f"{lake.root}/silver/due.json"
    return json.loads(paths.read_small(spark, file))["months"] if paths.exists(spark, file) else []


def backfill(spark: SparkSession, lake: Lake, first: str, last: str) -> None:
    """Rebuild gold for order dates in ``[first, last)`` from the retained silver tables."""
    to_gold(spark, lake, first, last)


def monthly_revenue_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All layers in a fresh lake under the shared folder; returns the monthly mart."""
    lake = Lake(scratch(spark, "lake"))
    raw = {name: table(spark, folder, name) for name in ("orders", "lineitem", "customer")}
    run_medallion(spark, raw, lake, "2024-04-01")
    return read_monthly(spark, lake)


def read_monthly(spark: SparkSession, lake: Lake) -> DataFrame:
    """The monthly mart in plain types."""
    return spark.read.parquet(lake.gold("fact_revenue_monthly")).select(
        F.col("month").cast("timestamp_ntz").alias("month"),
        "segment",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "order_count",
        F.round("avg_order_value", 6).alias("avg_order_value"),
    )
