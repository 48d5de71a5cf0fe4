"""Event log to two running KPI tables, with a quarantine for malformed records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sinks.streams import append_to_path, checkpoint_for, each_batch
from tidemark.sources.event_log import EventLog, read_event_log
from tidemark.streaming.progress import await_all
from tidemark.streaming.rides import CODE, TEXT, checked_rides, parse_rides, pickup_traffic, vendor_revenue


@dataclass(frozen=True)
class KpiSinks:
    """Folders of the KPI tables, the quarantine and the checkpoints."""

    root: str

    @property
    def vendor_revenue(self) -> str:
        return f"{self.root}/kpi_vendor_revenue"

    @property
    def pickup_traffic(self) -> str:
        return f"{self.root}/kpi_pickup_traffic"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/malformed_rides"

    def checkpoint(self, sink: str) -> str:
        return checkpoint_for(f"{self.root}/_checkpoints", sink)


def add_up(table: SnapshotTable, partial: DataFrame, keys: Sequence[str], number: int) -> None:
    """Add the sums of a micro-batch to the version before its number; a replay adds them once."""
    before = table.read(before=number)
    both = partial if before is None else before.unionByName(partial)
    sums = [F.sum(c).alias(c) for c in partial.columns if c not in keys]
    table.write(both.groupBy(*keys).agg(*sums), number)


def start_ride_kpis(
    spark: SparkSession, log: EventLog, sinks: KpiSinks, trigger: str = "availableNow", interval: str = "10 seconds",
    quarantine: bool = True,
) -> list[StreamingQuery]:
    """Start one query that reads and parses the log once, for both KPI tables and the quarantine.

    Each micro-batch sums up by itself and adds to the tables, so there is no streaming
    state. Each sink is written by batch number: after a crash between two of
    them the batch is repeated, and what it had written is replaced.
    """
    fields = ("vendorID", "totalAmount", "puLocationId")

    def write(batch: DataFrame, number: int) -> None:
        rides = checked_rides(batch, fields) if quarantine else parse_rides(batch, True, only=fields)
        rides = rides.persist()  # three sinks; if a part is lost it is parsed again
        try:
            good = rides.where(F.col(CODE).isNull()) if quarantine else rides
            add_up(SnapshotTable(spark, sinks.vendor_revenue), vendor_revenue(good), ["vendorID"], number)
            add_up(SnapshotTable(spark, sinks.pickup_traffic), pickup_traffic(good), ["puLocationId"], number)
            if quarantine:
                bad = rides.where(F.col(CODE).isNotNull()).select(F.col(TEXT).alias("value"), F.col(CODE).alias("error_code"))
                bad.write.mode("overwrite").parquet(f"{sinks.quarantine}/_batch_id={number}")
        finally:
            rides.unpersist()

    raw = read_event_log(spark, log)
    return [each_batch(raw, write, "append", sinks.checkpoint("ride-kpis"), trigger, interval)]


def run_ride_kpis(spark: SparkSession, log: EventLog, sinks: KpiSinks, timeout: float | None = None) -> bool:
    """Process everything in the log, then return; errors of either table are raised."""
    return await_all(start_ride_kpis(spark, log, sinks), timeout)


def run_ride_windows(
    spark: SparkSession, log: EventLog, path: str, size: str = "1 hour", delay: str = "10 minutes",
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Log straight to a gold table: revenue and trips per vendor and window, deduplicated.

    A ride is taken as a copy of another when vendor, both times, both places and
    amount agree.
    """
    from tidemark.streaming.windows import deduplicate

    business_key = ["vendorID", "tpepPickupDateTime", "tpepDropoffDateTime", "puLocationId", "doLocationId", "totalAmount"]
    rides = parse_rides(read_event_log(spark, log), only=business_key)
    unique = deduplicate(rides, business_key, "event_time", delay)
    gold = unique.groupBy(F.window("event_time", size).alias("_w"), "vendorID").agg(
        F.sum("totalAmount").alias("totalAmount"), F.count(F.lit(1)).alias("trips")
    )
    gold = gold.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "vendorID", "totalAmount", "trips"
    )
    return append_to_path(gold, path, checkpoint_for(f"{path}_checkpoints", path), trigger=trigger)
