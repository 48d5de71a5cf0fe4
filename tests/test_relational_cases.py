"""Small literal cases for sums, counts, filters and joins."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.streaming.rides import RIDE_SCHEMA, parse_rides, pickup_traffic, vendor_revenue

RIDES = [
    ("north", 1717200000000, 1717200840000, "harbour", 11.75),
    ("south", 1717203605000, 1717204805000, "harbour", 8.50),
    ("north", 1717210812000, 1717214412000, "old town", 32.25),
    ("west", 1717218000000, 1717218060000, "airport", 0.0),
    ("south", 1717221600000, 1717225200000, "airport", 54.00),
]


def as_map(df):
    return {r[0]: r[1] for r in df.collect()}


def amounts(spark, rows):
    return spark.createDataFrame(rows, "vendorID string, totalAmount double")


@pytest.fixture(scope="module")
def raw(spark):
    rows = spark.createDataFrame(
        RIDES, "vendorID string, tpepPickupDateTime long, tpepDropoffDateTime long, puLocationId string, totalAmount double"
    )
    return rows.select(F.to_json(F.struct(*rows.columns)).cast("binary").alias("value"))


def test_parsed_columns_and_times(raw):
    parsed = parse_rides(raw)
    assert parsed.columns == [*RIDE_SCHEMA.names, "event_time", "pickup_time", "dropoff_time"]
    assert parsed.count() == len(RIDES)
    first = parsed.orderBy("tpepPickupDateTime").select(
        *[F.col(c).cast("string").alias(c) for c in ("event_time", "pickup_time", "dropoff_time")]
    ).first()
    assert first["event_time"] == first["pickup_time"] == "2024-06-01 00:00:00"
    assert first["dropoff_time"] == "2024-06-01 00:14:00"
    assert all(f.nullable for f in RIDE_SCHEMA.fields) and len(RIDE_SCHEMA.fields) == 17


def test_revenue_and_traffic(raw):
    parsed = parse_rides(raw)
    revenue = as_map(vendor_revenue(parsed))
    want = {}
    for vendor, _, _, _, amount in RIDES:
        want[vendor] = want.get(vendor, 0) + amount
    assert revenue == pytest.approx(want)
    assert as_map(pickup_traffic(parsed)) == dict(Counter(r[3] for r in RIDES))
    assert pickup_traffic(parsed).columns == ["puLocationId", "count"]


def test_malformed_records_go_to_quarantine(spark):
    from tidemark.streaming.rides import malformed_rides

    bad = ["{vendorID=v1}", "<ride/>", "", None, '[{"vendorID": "v"}]', '{"vendorID": "v1", "tot']
    good = '{"vendorID": "v1", "totalAmount": 2.5, "improvementSurcharge": 0.3}'
    raw = spark.createDataFrame([(t,) for t in [*bad, good]], "value string")
    assert [tuple(r) for r in vendor_revenue(parse_rides(raw)).collect()] == [("v1", 2.5)]
    assert {r["error_code"] for r in malformed_rides(raw).collect()} == {"bad_json"}
    kept = as_map(vendor_revenue(parse_rides(raw, keep_malformed=True)))
    assert kept == {"v1": 2.5, None: None}


def test_a_field_that_does_not_fit_sends_the_ride_to_quarantine(spark):
    from tidemark.streaming.rides import malformed_rides

    bad = ['{"vendorID": "v1", "totalAmount": "abc"}', '{"vendorID": "v1", "totalAmount": 9, "passengerCount": "two"}']
    good = ['{"vendorID": "v1", "totalAmount": 4, "passengerCount": null}', '{"vendorID": 7, "unknown": {"a": 1}}']
    raw = spark.createDataFrame([(t,) for t in bad + good], "value string")
    assert sorted(tuple(r) for r in malformed_rides(raw).collect()) == sorted((t, "bad_field") for t in bad)
    assert as_map(vendor_revenue(parse_rides(raw, only=("vendorID", "totalAmount")))) == {"v1": 4.0, "7": None}
    assert as_map(vendor_revenue(parse_rides(raw, keep_malformed=True))) == {"v1": 13.0, "7": None}


def test_malformed_count(spark):
    from tidemark.streaming.rides import malformed_rides

    raw = spark.createDataFrame([('{"vendorID',), (None,), ("{}",), ('{"vendorID":"a"}',)], "value string")
    assert malformed_rides(raw).count() == 2
    assert parse_rides(raw).count() == 2


# Sums and counts are worked out from generated bookings: seeded amounts in cents, some refunds, some unknown.


def bookings(seed, companies=7, size=90):
    rng = random.Random(seed)
    rows = []
    for _ in range(size):
        cents = None if rng.random() < 0.15 else rng.randint(-900, 4_000)
        rows.append((f"company-{rng.randrange(companies)}", None if cents is None else cents / 100))
    return rows


def totals(rows):
    """Sum of the known amounts of each company; None where none is known."""
    known = {}
    for company, amount in rows:
        before = known.setdefault(company, None)
        if amount is not None:
            known[company] = amount if before is None else before + amount
    return {company: None if total is None else pytest.approx(total) for company, total in known.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_take_known_amounts_and_refunds(spark, seed):
    rows = [*bookings(seed), ("company-silent", None), ("company-silent", None)]
    found = as_map(vendor_revenue(amounts(spark, rows)))
    assert found == totals(rows) and found["company-silent"] is None
    assert any(amount is not None and amount < 0 for _, amount in rows)


def test_empty_input_has_no_groups(spark):
    empty = spark.createDataFrame([], RIDE_SCHEMA)
    assert vendor_revenue(empty).count() == 0
    assert pickup_traffic(empty).count() == 0


def test_one_company_is_one_group(spark):
    rows = bookings(3, companies=1)
    assert as_map(vendor_revenue(amounts(spark, rows))) == totals(rows)


def test_a_filter_below_the_sum_removes_groups(spark):
    rows = bookings(4)
    bar = sorted(amount for _, amount in rows if amount is not None)[-6]
    kept = [(company, amount) for company, amount in rows if amount is not None and amount >= bar]
    found = as_map(vendor_revenue(amounts(spark, rows).where(F.col("totalAmount") >= bar)))
    assert found == totals(kept) and len(found) < len(totals(rows))


def test_trips_per_place(spark):
    rng = random.Random(5)
    places = [None if rng.random() < 0.1 else f"stop {rng.randrange(9)}" for _ in range(150)]
    frame = spark.createDataFrame([(place,) for place in places], "puLocationId string")
    assert as_map(pickup_traffic(frame)) == Counter(places)


def test_sums_by_two_keys(spark):
    rng = random.Random(6)
    rows = [(company, rng.choice("NESW"), amount) for company, amount in bookings(6)]
    expected = totals([((company, side), amount) for company, side, amount in rows])
    frame = spark.createDataFrame(rows, "company string, side string, amount double")
    got = {(r.company, r.side): r.total for r in frame.groupBy("company", "side").agg(F.sum("amount").alias("total")).collect()}
    assert got == expected


def test_joins_with_and_without_partners(spark):
    rows = bookings(7, companies=4)
    frame = spark.createDataFrame(rows, "company string, amount double")
    depots = [(f"company-{i}", f"depot {i * i}") for i in (0, 2, 9)]
    joined = frame.join(spark.createDataFrame(depots, "company string, depot string"), "company", "inner")
    partner = dict(depots)
    assert Counter(tuple(r) for r in joined.collect()) == Counter((c, a, partner[c]) for c, a in rows if c in partner)
    left = spark.createDataFrame(depots, "company string, depot string").join(frame.groupBy("company").count(), "company", "left")
    trips = Counter(c for c, _ in rows)
    assert {r.company: r["count"] for r in left.collect()} == {c: trips.get(c) for c, _ in depots}


def test_null_filters_and_distinct(spark):
    rows = bookings(8)
    frame = amounts(spark, rows)
    unknown = sum(amount is None for _, amount in rows)
    assert frame.where(F.col("totalAmount").isNull()).count() == unknown > 0
    assert frame.where(F.col("totalAmount").isNotNull()).count() == len(rows) - unknown
    assert {r.vendorID for r in frame.select("vendorID").distinct().collect()} == {company for company, _ in rows}
