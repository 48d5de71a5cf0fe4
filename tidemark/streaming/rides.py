"""Ride events and the two running KPI tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import epoch_ms_to_ts
from tidemark.sources.event_log import decode_text

# Names and types of the fields of a ride event, all nullable.
RIDE_FIELDS = {
    "vendorID": T.StringType(),
    "tpepPickupDateTime": T.LongType(),
    "tpepDropoffDateTime": T.LongType(),
    "passengerCount": T.IntegerType(),
    "tripDistance": T.DoubleType(),
    "puLocationId": T.StringType(),
    "doLocationId": T.StringType(),
    "rateCodeId": T.IntegerType(),
    "storeAndFwdFlag": T.StringType(),
    "paymentType": T.IntegerType(),
    "fareAmount": T.DoubleType(),
    "extra": T.DoubleType(),
    "mtaTax": T.DoubleType(),
    "improvementSurcharge": T.DoubleType(),
    "tipAmount": T.DoubleType(),
    "tollsAmount": T.DoubleType(),
    "totalAmount": T.DoubleType(),
}
RIDE_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in RIDE_FIELDS.items()])


def is_record(text: Column) -> Column:
    """Whether the text is one JSON object; arrays, fragments and NULL are not."""
    return F.json_object_keys(text).isNotNull()


MISFIT = "_misfit"


def _typed(text: Column) -> Column:
    """The ride fields, and the whole text in ``_misfit`` if any field does not fit its type."""
    schema = T.StructType([*RIDE_SCHEMA.fields, T.StructField(MISFIT, T.StringType())])
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": MISFIT})


def parse_rides(raw: DataFrame, keep_malformed: bool = False, only: Collection[str] | None = None) -> DataFrame:
    """``value`` to ride fields plus event, pickup and drop-off times.

    Records that are not JSON objects, or have a field that does not fit its type,
    are left to ``malformed_rides``. With ``keep_malformed`` they stay, with NULL for
    what cannot be read, and the former form a NULL group. ``only`` names the ride
    fields that are returned; the times come with the fields they are made from.
    """
    schema = T.StructType([f for f in RIDE_SCHEMA.fields if only is None or f.name in only])
    text = raw.select(decode_text(F.col("value")).alias("text"))
    if keep_malformed:
        rides = text.select(F.from_json("text", schema).alias("ride")).select("ride.*")
    else:
        typed = text.where(is_record(F.col("text"))).select(_typed(F.col("text")).alias("ride"))
        rides = typed.where(F.col("ride").getField(MISFIT).isNull()).select(*[f"ride.{name}" for name in schema.names])
    times = {}
    if "tpepPickupDateTime" in schema.names:
        times["event_time"] = times["pickup_time"] = epoch_ms_to_ts(F.col("tpepPickupDateTime"))
    if "tpepDropoffDateTime" in schema.names:
        times["dropoff_time"] = epoch_ms_to_ts(F.col("tpepDropoffDateTime"))
    return rides.withColumns(times) if times else rides


CODE = "_error_code"
TEXT = "_text"


def checked_rides(raw: DataFrame, only: Collection[str]) -> DataFrame:
    """``value`` to the named ride fields, good and bad records in one pass.

    ``_error_code`` and ``_text`` are as in ``malformed_rides``, NULL for good records.
    """
    text = raw.select(decode_text(F.col("value")).alias(TEXT))
    parsed = text.select(TEXT, F.when(is_record(F.col(TEXT)), _typed(F.col(TEXT))).alias("_ride"))
    ride = F.col("_ride")
    code = F.when(ride.isNull(), F.lit("bad_json")).when(ride.getField(MISFIT).isNotNull(), F.lit("bad_field"))
    coded = parsed.withColumn(CODE, code)
    return coded.select(*[ride.getField(name).alias(name) for name in only], CODE, F.when(F.col(CODE).isNotNull(), F.col(TEXT)).alias(TEXT))


def malformed_rides(raw: DataFrame) -> DataFrame:
    """The raw text of records that cannot be parsed, for the quarantine sink.

    ``bad_json``: not a JSON object; ``bad_field``: a field does not fit its type.
    """
    value = F.col("value")
    misfit = _typed(value).getField(MISFIT).isNotNull()
    code = F.when(~is_record(value), F.lit("bad_json")).when(misfit, F.lit("bad_field"))
    text = raw.select(decode_text(value).alias("value"))
    return text.withColumn("error_code", code).where(F.col("error_code").isNotNull())


def vendor_revenue(rides: DataFrame) -> DataFrame:
    """Total amount per vendor over all time; NULL amounts are ignored.

    The key is no event time, so state grows with the number of vendors only and
    a watermark would have nothing to expire.
    """
    return rides.groupBy("vendorID").agg(F.sum("totalAmount").alias("totalAmount"))


def pickup_traffic(rides: DataFrame) -> DataFrame:
    """Trips per pickup location over all time."""
    return rides.groupBy("puLocationId").agg(F.count(F.lit(1)).alias("count"))
