"""Streams: KPI pipeline, late data, restarts, upserts and progress."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans import ride_kpis
from tidemark.plans.ride_kpis import KpiSinks, add_up, run_ride_kpis, run_ride_windows, start_ride_kpis
from tidemark.sinks.parts import PartTable
from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sinks.streams import append_to_path, append_to_table, checkpoint_for, each_batch, replace_snapshot, upsert_parts, upsert_snapshot
from tidemark.sources.event_log import EventLog, broker, decode_avro, read_event_log
from tidemark.streaming import progress
from tidemark.streaming.rides import parse_rides, vendor_revenue
from tidemark.streaming.windows import deduplicate, sessions, sliding, tumbling


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def arrive(folder, name, records):
    """One file of JSON lines; file names order by time of arrival."""
    import os
    import time

    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
    stamp = time.time() - 1000 + 10 * len(os.listdir(folder))
    os.utime(path, (stamp, stamp))


def ride(vendor, place, amount, at=1609459200000):
    return {"vendorID": vendor, "puLocationId": place, "totalAmount": amount, "tpepPickupDateTime": at, "tpepDropoffDateTime": at + 60000}


def test_kpis_accumulate_over_restarts(spark, folder):
    log, sinks = EventLog("text", f"{folder}/log"), KpiSinks(f"{folder}/kpis")
    arrive(f"{folder}/log", "1", [ride("v1", "A", 10.5), ride("v2", "A", 1.0), "broken {"])
    assert run_ride_kpis(spark, log, sinks, timeout=120)
    arrive(f"{folder}/log", "2", [ride("v1", "B", 4.5), ride("v2", "A", None)])
    assert run_ride_kpis(spark, log, sinks, timeout=120)
    assert run_ride_kpis(spark, log, sinks, timeout=120)  # nothing new
    assert rows(SnapshotTable(spark, sinks.vendor_revenue).read()) == [("v1", 15.0), ("v2", 1.0)]
    assert rows(SnapshotTable(spark, sinks.pickup_traffic).read()) == [("A", 3), ("B", 1)]
    assert rows(spark.read.parquet(sinks.quarantine).drop("_batch_id")) == [("broken {", "bad_json")]


def test_the_log_is_read_once_for_all_sinks(spark, folder):
    log, sinks = EventLog("text", f"{folder}/log"), KpiSinks(f"{folder}/kpis")
    arrive(f"{folder}/log", "1", [ride("v1", "A", 10.5), "broken {", {"vendorID": "v1", "totalAmount": "x"}])
    started = start_ride_kpis(spark, log, sinks)
    progress.await_all(started)
    assert len(started) == 1 and len(json.loads(started[0].lastProgress.json)["sources"]) == 1
    read = sum(s["numInputRows"] for p in started[0].recentProgress for s in json.loads(p.json)["sources"])
    assert read == 3
    assert rows(spark.read.parquet(sinks.quarantine).select("error_code")) == [("bad_field",), ("bad_json",)]


@pytest.mark.parametrize("stop_at", [1, 2])
def test_a_crash_between_two_sinks_repeats_nothing(spark, folder, monkeypatch, stop_at):
    log, sinks = EventLog("text", f"{folder}/log"), KpiSinks(f"{folder}/kpis")
    arrive(f"{folder}/log", "1", [ride("v1", "A", 10.5), "broken {"])
    assert run_ride_kpis(spark, log, sinks, timeout=120)
    arrive(f"{folder}/log", "2", [ride("v1", "B", 4.5), "worse {"])
    calls = []

    def fails(*args):
        calls.append(args)
        if len(calls) == stop_at:
            raise RuntimeError("lost")
        return add_up(*args)

    with monkeypatch.context() as patch:
        patch.setattr(ride_kpis, "add_up", fails)
        with pytest.raises(Exception, match="lost"):
            run_ride_kpis(spark, log, sinks, timeout=120)
    for _ in range(2):
        assert run_ride_kpis(spark, log, sinks, timeout=120)
        assert rows(SnapshotTable(spark, sinks.vendor_revenue).read()) == [("v1", 15.0)]
        assert rows(SnapshotTable(spark, sinks.pickup_traffic).read()) == [("A", 1), ("B", 1)]
        assert rows(spark.read.parquet(sinks.quarantine).select("value")) == [("broken {",), ("worse {",)]


def test_a_batch_with_one_key_writes_one_part(spark, folder):
    table = PartTable(spark, f"{folder}/t", ["k"], parts=32)
    schema = "k string, v int"
    for number, records in enumerate(([{"k": f"k{i}", "v": 1} for i in range(200)], [{"k": "k7", "v": 5}], [{"k": None, "v": 2}])):
        arrive(f"{folder}/in", str(number), records)
        totals = spark.readStream.schema(schema).json(f"{folder}/in").groupBy("k").agg(F.sum("v").alias("v"))
        upsert_parts(totals, table, ["k"], f"{folder}/c", trigger="availableNow").awaitTermination()
        if number:
            before, now = table.manifest(before=table.versions()[-1]).folders, table.manifest().folders
            assert len({p for p in now if now[p] != before.get(p)}) == 1
    got = dict(rows(table.read()))
    assert len(got) == 201 and got["k7"] == 6 and got[None] == 2 and got["k8"] == 1


def test_reference_behaviour_counts_malformed_under_null(spark, folder):
    log, sinks = EventLog("text", f"{folder}/log"), KpiSinks(f"{folder}/kpis")
    arrive(f"{folder}/log", "1", ["x", "y", ride("v1", "A", 1.0)])
    progress.await_all(start_ride_kpis(spark, log, sinks, quarantine=False))
    assert rows(SnapshotTable(spark, sinks.pickup_traffic).read()) == [("A", 1), (None, 2)]


def test_rides_straight_to_gold_windows(spark, folder):
    hour = 3600000
    base = 1609459200000
    copies = [ride("v1", "A", 5.0, base + 1000)] * 2
    arrive(f"{folder}/log", "1", [*copies, ride("v1", "A", 7.0, base + 2000), ride("v1", "B", 1.0, base + 5 * hour)])
    run_ride_windows(spark, EventLog("text", f"{folder}/log"), f"{folder}/gold").awaitTermination()
    got = [(r["vendorID"], r["totalAmount"], r["trips"]) for r in spark.read.parquet(f"{folder}/gold").collect()]
    assert got == [("v1", 12.0, 2)]


def test_only_named_fields_are_parsed(spark, folder):
    arrive(f"{folder}/log", "1", [ride("v1", "A", 1.0)])
    raw = spark.read.text(f"{folder}/log")
    parsed = parse_rides(raw, only=("vendorID", "totalAmount"))
    assert parsed.columns == ["vendorID", "totalAmount"]
    assert rows(vendor_revenue(parsed)) == [("v1", 1.0)]
    unchecked = parse_rides(raw, keep_malformed=True, only=("vendorID", "totalAmount"))  # fields that are not checked are not converted
    assert "tpepPickupDateTime" not in unchecked._jdf.queryExecution().optimizedPlan().toString()
    assert parse_rides(raw, only=("tpepPickupDateTime",)).columns == ["tpepPickupDateTime", "event_time", "pickup_time"]


@pytest.fixture
def late(spark, folder):
    """Times 01:00, 00:00, 00:01, 03:00 in one file each, read one per batch."""
    for i, at in enumerate(["01:00", "00:00", "00:01", "03:00"]):
        arrive(f"{folder}/in", str(i), [{"t": f"2024-01-01 {at}:00", "v": i}])
    stream = spark.readStream.schema("t timestamp, v int").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    return stream


def test_late_rows_are_dropped_from_the_third_batch_on(spark, folder, late):
    counted = tumbling(late, "t", "5 minutes", [], [F.count(F.lit(1)).alias("n")])
    query = append_to_path(counted, f"{folder}/out", f"{folder}/c", trigger="availableNow")
    query.awaitTermination()
    got = {r["window_start"].strftime("%H:%M"): r["n"] for r in spark.read.parquet(f"{folder}/out").collect()}
    # the second row still found its window open, the third did not; 03:00 is not closed
    assert got == {"00:00": 1, "01:00": 1}
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in json.loads(p.json)["stateOperators"])
    assert dropped == 1


def test_all_time_totals_ignore_lateness(spark, folder, late):
    total = late.withWatermark("t", "10 minutes").groupBy().agg(F.sum("v").alias("v"))
    t = SnapshotTable(spark, f"{folder}/total")
    replace_snapshot(total, t, f"{folder}/c", trigger="availableNow").awaitTermination()
    assert rows(t.read()) == [(6,)]


def test_windows_on_batch_frames(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=m)
    df = spark.createDataFrame([("a", at(0)), ("a", at(4)), ("a", at(7)), ("a", at(37)), ("b", at(1))], "k string, t timestamp")
    n = [F.count(F.lit(1)).alias("n")]
    starts = lambda d: {(r["k"], int((r["window_start"] - at(0)).total_seconds() // 60)): r["n"] for r in d.collect()}
    assert starts(tumbling(df, "t", "5 minutes", ["k"], n)) == {("a", 0): 2, ("a", 5): 1, ("a", 35): 1, ("b", 0): 1}
    assert starts(sliding(df, "t", "10 minutes", "5 minutes", ["k"], n))[("a", 0)] == 3
    # a gap of exactly 30 minutes still belongs to the session
    assert starts(sessions(df, "t", "30 minutes", ["k"], n)) == {("a", 0): 4, ("b", 1): 1}
    assert starts(sessions(df, "t", "29 minutes", ["k"], n)) == {("a", 0): 3, ("a", 37): 1, ("b", 1): 1}
    assert deduplicate(df.unionByName(df), ["k", "t"], "t").count() == 5


def test_update_mode_upserts_and_replays(spark, folder):
    for i, pairs in enumerate([[("a", 1), ("b", 2)], [("a", 10)], [("c", 5), ("b", 1)]]):
        arrive(f"{folder}/in", str(i), [{"k": k, "v": v} for k, v in pairs])
    stream = spark.readStream.schema("k string, v bigint").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    totals = stream.groupBy("k").agg(F.sum("v").alias("v"))
    t = SnapshotTable(spark, f"{folder}/t", keep=10)
    upsert_snapshot(totals, t, ["k"], f"{folder}/c", trigger="availableNow").awaitTermination()
    assert rows(t.read()) == [("a", 11), ("b", 3), ("c", 5)]
    assert rows(t.read(before=1)) == [("a", 1), ("b", 2)]
    t.merge(spark.createDataFrame([("b", 3), ("c", 5)], "k string, v bigint"), ["k"], 2)  # batch 2 again
    assert rows(t.read()) == [("a", 11), ("b", 3), ("c", 5)]


def test_checkpoints_do_not_collide():
    assert checkpoint_for("/c", "a/b") != checkpoint_for("/c", "a_b")
    assert checkpoint_for("/c", "a") == checkpoint_for("/c/", "a")


def test_append_to_table_and_triggers(spark, folder):
    arrive(f"{folder}/in", "1", [{"k": "a"}])
    stream = spark.readStream.schema("k string").json(f"{folder}/in")
    append_to_table(stream, "appended", f"{folder}/c", f"{folder}/t", trigger="availableNow").awaitTermination()
    assert rows(spark.table("appended")) == [("a",)]
    with pytest.raises(ValueError, match="trigger"):
        append_to_path(stream, f"{folder}/x", f"{folder}/cx", trigger="hourly")


def test_failure_of_one_query_is_raised_and_stops_the_rest(spark, folder):
    arrive(f"{folder}/in", "1", [{"k": "a"}])
    stream = spark.readStream.schema("k string").json(f"{folder}/in")

    def fail(batch, number):
        raise RuntimeError("sink is down")

    running = append_to_path(stream, f"{folder}/ok", f"{folder}/c1", interval="1 second")
    failing = each_batch(stream, fail, "append", f"{folder}/c2", trigger="availableNow")
    with pytest.raises(Exception, match="sink is down"):
        progress.await_all([running, failing], timeout=60)
    assert not running.isActive


def test_status_stop_timeout_and_history(spark, folder):
    assert progress.status(None) == {"status": "No active query"}
    progress.stop(None)
    log = progress.ProgressLog(spark)
    spark.streams.addListener(log)
    try:
        arrive(f"{folder}/in", "1", [{"k": "a"}, {"k": "b"}])
        stream = spark.readStream.schema("k string").json(f"{folder}/in")
        query = append_to_path(stream, f"{folder}/out", f"{folder}/c", interval="1 second")
        query.processAllAvailable()
        assert progress.await_all([query], timeout=0.1) is False
        state = progress.status(query)
        assert state["is_active"] and state["id"] == query.id and state["recent_progress"] is not None
        progress.stop(query)
        assert not query.isActive
        import time

        for _ in range(50):
            seen = progress.throughput(log.history().where(F.col("query_id") == str(query.id))).collect()
            if seen and seen[0]["input_rows"] == 2:
                break
            time.sleep(0.1)
        assert seen[0]["input_rows"] == 2 and seen[0]["late_rows_dropped"] == 0
    finally:
        spark.streams.removeListener(log)


def test_broker_options():
    log = broker("h:9093", "rides", jaas="login")
    assert log.format == "kafka" and log.options["subscribe"] == "rides"
    assert log.options["startingOffsets"] == "earliest" and log.options["kafka.security.protocol"] == "SASL_SSL"
    assert "kafka.sasl.mechanism" not in broker("h:9092", "rides").options


def test_missing_connectors_say_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_event_log(spark, broker("localhost:1", "t"))
    with pytest.raises(Exception, match="(?i)avro"):
        df = spark.createDataFrame([(bytearray(b"x"),)], "v binary")
        df.select(decode_avro(F.col("v"), '{"type":"string"}')).collect()


def test_progress_history_is_complete(spark, folder):
    log = progress.ProgressLog(spark, rows_per_file=1000, path=f"{folder}/progress")
    row = ("q", None, 1, "2024-01-01T00:00:00Z", 1, 1.0, 1.0, 0)
    for _ in range(3):
        log._rows += [row] * 7
        log.flush()
    log._rows.append(row)
    assert log.history().count() == 22
    assert progress.throughput(log.history()).first()["input_rows"] == 22
