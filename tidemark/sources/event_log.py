"""Event logs: one record per row in a ``value`` column, from a broker or from files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro


@dataclass(frozen=True)
class EventLog:
    """Any streaming source that yields ``value``; ``path`` is for file sources."""

    format: str = "text"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def broker(servers: str, topic: str, starting: str = "earliest", jaas: str | None = None, **extra: str) -> EventLog:
    """A Kafka topic. ``jaas`` is the caller's login line; giving it turns on SASL_SSL."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if jaas:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        }
    return EventLog("kafka", None, options | extra)


def read_event_log(spark: SparkSession, log: EventLog) -> DataFrame:
    """Streaming DataFrame with a ``value`` column."""
    reader = spark.readStream.format(log.format).options(**log.options)
    return reader.load(log.path) if log.path else reader.load()


def decode_avro(value: Column, schema: str, **options: str) -> Column:
    """Avro bytes to a struct; the session needs the separate spark-avro package."""
    return from_avro(value, schema, dict(options))


def decode_text(value: Column) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.col(value).cast("string")
