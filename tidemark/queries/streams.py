"""Streaming queries over the events table, drained with an available-now trigger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.ride_kpis import KpiSinks, run_ride_windows, start_ride_kpis
from tidemark.queries import query
from tidemark.session import scratch, table
from tidemark.sinks import paths
from tidemark.sinks.parts import PartTable
from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sinks.streams import append_to_path, replace_snapshot, upsert_parts
from tidemark.sources.event_log import EventLog, read_event_log
from tidemark.streaming.progress import await_all
from tidemark.streaming.rides import RIDE_SCHEMA, parse_rides, pickup_traffic
from tidemark.streaming.windows import deduplicate, sessions, sliding, tumbling


def ride_records(spark, folder):
    """Events as ride records: one JSON text per row."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    known = {
        "vendorID": F.col("event_type"),
        "tpepPickupDateTime": ms,
        "tpepDropoffDateTime": ms + F.col("user_id") * 1000,
        "passengerCount": (F.col("user_id") % 5).cast("int"),
        "puLocationId": F.col("user_id").cast("string"),
        "totalAmount": F.col("value"),
    }
    fields = [
        known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in RIDE_SCHEMA.fields
    ]
    return table(spark, folder, "events").select(F.to_json(F.struct(*fields)).alias("value"))


def ride_log(spark, folder) -> EventLog:
    path = scratch(spark, "ride-log")
    ride_records(spark, folder).write.text(path)
    return EventLog("text", path)


def event_stream(spark, folder, files: int | None = None):
    """The events table as a stream, its times as instants.

    ``files`` asks for that many files, read one per micro-batch.
    """
    events = table(spark, folder, "events")
    # a glob, since the file source takes a plain path for a directory
    path = f"{folder.rstrip('/')}/events.parque[t]"
    reader = spark.readStream.schema(events.schema)
    if files:
        path = scratch(spark, "event-files")
        events.repartitionByRange(files, "ts").write.parquet(path)
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def drained(spark, df, name, fmt="parquet"):
    """Append all of the stream to files and read them."""
    path = scratch(spark, name)
    await_all([append_to_path(df, path, f"{path}-checkpoint", fmt, "availableNow")])
    return spark.read.schema(df.schema).parquet(path)


def plain_times(df):
    """Instants back to times without a zone, as the tables have them."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"})


@query(
    "ride_events_parsed",
    """select event_type as "vendorID", epoch_us(ts) // 1000 as "tpepPickupDateTime",
              cast(user_id % 5 as integer) as "passengerCount", cast(user_id as varchar) as "puLocationId", value as "totalAmount",
              date_trunc('second', ts)::timestamp as event_time, date_trunc('second', ts)::timestamp as pickup_time,
              make_timestamp((epoch_us(ts) // 1000 + user_id * 1000) // 1000 * 1000000) as dropoff_time from events""",
)
def ride_events_parsed(spark, folder):
    rides = parse_rides(read_event_log(spark, ride_log(spark, folder)))
    columns = [
        "vendorID", "tpepPickupDateTime", "passengerCount", "puLocationId", "totalAmount",
        "event_time", "pickup_time", "dropoff_time",
    ]
    return plain_times(drained(spark, rides.select(*columns), "rides"))


@query(
    "kpi_vendor_revenue",
    """select event_type as "vendorID", round(cast(sum(cast(value as decimal(12,2))) as double), 2) as "totalAmount"
       from events group by event_type""",
)
def kpi_vendor_revenue(spark, folder):
    sinks = KpiSinks(scratch(spark, "kpis"))
    await_all(start_ride_kpis(spark, ride_log(spark, folder), sinks))
    return SnapshotTable(spark, sinks.vendor_revenue).read().withColumn("totalAmount", F.round("totalAmount", 2))


@query(
    "kpi_pickup_traffic",
    """select cast(user_id as varchar) as "puLocationId", count(*) as "count" from events group by user_id""",
)
def kpi_pickup_traffic(spark, folder):
    rides = parse_rides(read_event_log(spark, ride_log(spark, folder)), only=("puLocationId",))
    traffic = SnapshotTable(spark, scratch(spark, "traffic"))
    await_all([replace_snapshot(pickup_traffic(rides), traffic, f"{traffic.path}-checkpoint", trigger="availableNow")])
    return traffic.read()


@query(
    "kpi_field_misfit",
    """select event_type as vendor, 'kpi' as kept_in, count(*) as n from events where user_id % 5 <> 0 group by 1
       union all select event_type, 'quarantine', count(*) from events where user_id % 5 = 0 group by 1""",
)
def kpi_field_misfit(spark, folder):
    """Every fifth user's amount is no number: those rides are in the quarantine and in no KPI."""
    amount = F.when(F.col("user_id") % 5 == 0, F.lit("abc")).otherwise(F.col("value").cast("string"))
    ride = F.struct(F.col("event_type").alias("vendorID"), F.col("event_type").alias("puLocationId"), amount.alias("totalAmount"))
    path = scratch(spark, "misfit-log")
    records = table(spark, folder, "events").select(F.to_json(ride).alias("value"))
    records.withColumn("value", F.regexp_replace("value", r'"totalAmount":"([-0-9.E]+)"', r'"totalAmount":$1')).write.text(path)
    sinks = KpiSinks(scratch(spark, "misfit-kpis"))
    await_all(start_ride_kpis(spark, EventLog("text", path), sinks))
    kept = SnapshotTable(spark, sinks.pickup_traffic).read().select(
        F.col("puLocationId").alias("vendor"), F.lit("kpi").alias("kept_in"), F.col("count").alias("n")
    )
    bad = spark.read.parquet(sinks.quarantine).where("error_code = 'bad_field'")
    bad = bad.groupBy(F.get_json_object("value", "$.vendorID").alias("vendor")).agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(bad.withColumn("kept_in", F.lit("quarantine")))


MEASURES_SQL = "count(*) as n, cast(sum(cast(value as decimal(12,2))) as double) as amount"
CLOSED_SQL = "(select max(ts) - interval 10 minute from events)"


def measures():
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(12,2)")).alias("amount"),
    ]


def closed(spark, windowed, name):
    """Final windows, in append mode: those that ended before the watermark."""
    result = plain_times(drained(spark, windowed, name))
    return result.withColumn("amount", F.col("amount").cast("double"))


@query(
    "stream_tumbling",
    f"""with w as (select time_bucket(interval 5 minute, ts) as window_start, event_type, {MEASURES_SQL} from events group by 1, 2)
       select window_start, window_start + interval 5 minute as window_end, event_type, n, amount from w
       where window_start + interval 5 minute <= {CLOSED_SQL}""",
)
def stream_tumbling(spark, folder):
    windows = tumbling(event_stream(spark, folder), "ts", "5 minutes", ["event_type"], measures())
    return closed(spark, windows, "tumbling")


@query(
    "stream_sliding",
    f"""with e as (select *, unnest([time_bucket(interval 5 minute, ts), time_bucket(interval 5 minute, ts) - interval 5 minute]) as window_start
                  from events),
            w as (select window_start, event_type, {MEASURES_SQL} from e group by 1, 2)
       select window_start, window_start + interval 10 minute as window_end, event_type, n, amount from w
       where window_start + interval 10 minute <= {CLOSED_SQL}""",
)
def stream_sliding(spark, folder):
    windows = sliding(event_stream(spark, folder), "ts", "10 minutes", "5 minutes", ["event_type"], measures())
    return closed(spark, windows, "sliding")


@query(
    "stream_session",
    f"""with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 30 minute then 0 else 1 end as starts
                  from events),
            s as (select *, sum(starts) over (partition by user_id order by ts, event_id) as session from g),
            w as (select user_id, min(ts) as window_start, max(ts) + interval 30 minute as window_end, {MEASURES_SQL}
                  from s group by user_id, session)
       select window_start, window_end, user_id, n, amount from w where window_end <= {CLOSED_SQL}""",
)
def stream_session(spark, folder):
    windows = sessions(event_stream(spark, folder), "ts", "30 minutes", ["user_id"], measures())
    return closed(spark, windows, "sessions")


@query(
    "stream_min_max",
    f"""with w as (select time_bucket(interval 1 hour, ts) as window_start, event_type, count(*) as n,
                  min(value) as lowest, max(value) as highest from events group by 1, 2)
       select window_start, window_start + interval 1 hour as window_end, event_type, n, lowest, highest from w
       where window_start + interval 1 hour <= {CLOSED_SQL}""",
)
def stream_min_max(spark, folder):
    stats = [F.count(F.lit(1)).alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest")]
    windows = tumbling(event_stream(spark, folder), "ts", "1 hour", ["event_type"], stats)
    return plain_times(drained(spark, windows, "min-max"))


def arrivals(spark, rows, load, name):
    """Folders of ``rows`` by the number in ``load``, written at once; one after the other they may be moved to the source."""
    staged = scratch(spark, f"{name}-staged")
    rows.withColumn("_load", load).repartition("_load", F.pmod(F.xxhash64(*rows.columns), F.lit(4))).write.partitionBy("_load").parquet(staged)
    source = scratch(spark, f"{name}-source")
    folders = [(int(folder[6:]), folder) for folder in paths.children(spark, staged) if folder.startswith("_load=")]
    return source, [(f"{staged}/{folder}", f"{source}/{number}") for number, folder in sorted(folders)]


def drained_in_turn(spark, loads, source, make, schema, name):
    """Run a stream to its end after each arrival; ``make`` is given the source."""
    path = scratch(spark, name)
    for staged, arrived in loads:
        paths.rename(spark, staged, arrived)
        stream = make(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source))
        await_all([append_to_path(stream, path, f"{path}-checkpoint", "parquet", "availableNow")])
    return spark.read.schema(stream.schema).parquet(path)


@query(
    "stream_dedup",
    """select event_id, case when event_id % 97 <> 0 then ts end as ts, user_id, event_type, value from events""",
)
def stream_dedup(spark, folder):
    """Loads of a week of events, each with the load before it and the one before that again.

    Copies of the last load are recognised by the state; the older ones come after the
    watermark. Some events have no time; they are in the first three loads.
    """
    timed = F.when(F.col("event_id") % 97 != 0, F.col("ts")).alias("ts")
    events = table(spark, folder, "events").select("event_id", timed, "user_id", "event_type", "value")
    first = events.agg(F.min("ts")).first()[0]
    week = F.coalesce(F.floor(F.datediff("ts", F.lit(first)) / 7), F.lit(0)).cast("int")
    copies = events.withColumn("_copy", F.explode(F.array([F.lit(i) for i in range(3)])))
    source, loads = arrivals(spark, copies, week + F.col("_copy"), "event-loads")
    unique = lambda s: deduplicate(s.drop("_copy").withColumn("ts", F.col("ts").cast("timestamp")), ["event_id"], "ts", "8 days", untimed=True)
    return plain_times(drained_in_turn(spark, loads, source, unique, copies.schema, "deduplicated"))


@query(
    "stream_late_rows",
    f"""with late as (select max(ts) - interval 10 minute as mark from events where event_type <> 'error'),
            w as (select time_bucket(interval 1 hour, ts) as window_start, event_type from events),
            kept as (select w.* from w, late where event_type <> 'error' or window_start + interval 1 hour > mark)
       select window_start, window_start + interval 1 hour as window_end, count(*) as n from kept
       group by 1, 2 having window_end <= {CLOSED_SQL}""",
)
def stream_late_rows(spark, folder):
    """Errors arrive after everything else: those of windows that are closed by then do not count."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    load = F.when(F.col("event_type") == "error", 1).otherwise(0)
    source, loads = arrivals(spark, events, load, "late-events")
    hours = lambda s: tumbling(s.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", [], [F.count(F.lit(1)).alias("n")])
    return plain_times(drained_in_turn(spark, loads, source, hours, events.schema, "late-windows"))


@query(
    "stream_update_upsert",
    """select user_id, count(*) as n, cast(sum(cast(value as decimal(12,2))) as double) as amount, max(ts) as last_seen
       from events group by user_id""",
)
def stream_update_upsert(spark, folder):
    events = event_stream(spark, folder, files=4)
    totals = events.groupBy("user_id").agg(*measures(), F.max("ts").alias("last_seen"))
    target = PartTable(spark, scratch(spark, "user-totals"), ["user_id"])
    await_all([upsert_parts(totals, target, ["user_id"], f"{target.path}-checkpoint", trigger="availableNow")])
    return plain_times(target.read()).withColumn("amount", F.col("amount").cast("double"))


@query(
    "stream_ride_windows",
    """with rides as (select distinct event_type, user_id, value, epoch_us(ts) // 1000 as ms, date_trunc('second', ts)::timestamp as began from events),
            w as (select time_bucket(interval 1 hour, began) as window_start, event_type as "vendorID",
                         round(cast(sum(cast(value as decimal(12,2))) as double), 2) as "totalAmount", count(*) as trips
                  from rides group by 1, 2)
       select window_start, window_start + interval 1 hour as window_end, "vendorID", "totalAmount", trips from w
       where window_start + interval 1 hour <= (select max(began) - interval 10 minute from rides)""",
)
def stream_ride_windows(spark, folder):
    """The ride log, in which every record occurs twice, straight to hourly gold rows."""
    records = ride_records(spark, folder)
    log = scratch(spark, "ride-log")
    records.unionByName(records).write.text(log)
    path = scratch(spark, "ride-windows")
    await_all([run_ride_windows(spark, EventLog("text", log), path)])
    return plain_times(spark.read.parquet(path)).withColumn("totalAmount", F.round("totalAmount", 2))
