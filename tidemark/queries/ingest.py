"""File ingestion: formats, evolution, malformed records, restarts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries import query
from tidemark.session import scratch, table, unique_name
from tidemark.sinks.batch import export
from tidemark.streaming.ingester import FileIngester, IngestConfig

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def text_events(spark, folder):
    """Events with their time as text, as CSV and JSON carry it."""
    return table(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "user_id", "event_type", "value"
    )


TEXT_SQL = "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as at, user_id, event_type, value from events"


def ingester(spark, root: str, fmt: str, **options) -> FileIngester:
    return FileIngester(
        spark,
        IngestConfig(
            source_path=f"{root}/in",
            checkpoint_path=f"{root}/checkpoints",
            schema_location=f"{root}/schema",
            table_location=f"{root}/tables",
            file_format=fmt,
            **options,
        ),
    )


def drain(ingest: FileIngester, root: str):
    ingest.write_to_path(output_path=f"{root}/out", trigger_type="availableNow")
    ingest.await_termination()
    return ingest.read_output(f"{root}/out")


def text_times(df):
    """Inferred instants written out again."""
    kind = df.schema["at"].dataType.typeName()
    return df if kind == "string" else df.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("ingest_parquet_append", "select event_id, ts, user_id, event_type, value from events")
def ingest_parquet_append(spark, folder):
    root = scratch(spark, "ingest-parquet")
    table(spark, folder, "events").select(*EVENT_COLUMNS).repartition(6).write.parquet(f"{root}/in")
    return drain(ingester(spark, root, "parquet"), root)


@query("ingest_csv_typed", TEXT_SQL)
def ingest_csv_typed(spark, folder):
    root = scratch(spark, "ingest-csv")
    export(text_events(spark, folder).repartition(3), f"{root}/in", "csv")
    return text_times(drain(ingester(spark, root, "csv"), root))


@query("ingest_json_typed", TEXT_SQL)
def ingest_json_typed(spark, folder):
    root = scratch(spark, "ingest-json")
    export(text_events(spark, folder).repartition(3), f"{root}/in", "json")
    return text_times(drain(ingester(spark, root, "json"), root))


@query("ingest_recursive", "select event_id, user_id, event_type, value from events")
def ingest_recursive(spark, folder):
    root = scratch(spark, "ingest-nested")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    for name in ("click", "error", "purchase"):
        events.where(F.col("event_type") == name).write.parquet(f"{root}/in/deep/{name}")
    events.where(~F.col("event_type").isin("click", "error", "purchase")).write.parquet(f"{root}/in/rest")
    return drain(ingester(spark, root, "parquet", recursive=True), root)


@query("ingest_to_table", "select event_id, ts, user_id, event_type, value from events")
def ingest_to_table(spark, folder):
    root = scratch(spark, "ingest-table")
    table(spark, folder, "events").select(*EVENT_COLUMNS).repartition(4).write.parquet(f"{root}/in")
    ingest = ingester(spark, root, "parquet")
    name = unique_name("ingested_events")
    ingest.write_to_table(ingest.read_stream(), name, trigger_type="availableNow")
    ingest.await_termination()
    return spark.table(name).drop("_batch_id")


@query(
    "ingest_schema_evolution",
    """select event_id, user_id, value, case when event_type in ('click', 'error') then event_type end as event_type,
              case when event_type = 'error' then props end as props from events""",
)
def ingest_schema_evolution(spark, folder):
    """Three arrivals of CSV files: each brings one more column, in another order."""
    root = scratch(spark, "ingest-evolving")
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    arrivals = [
        (events.where(~kind.isin("click", "error")), ["event_id", "user_id", "value"]),
        (events.where(kind == "click"), ["event_type", "event_id", "value", "user_id"]),
        (events.where(kind == "error"), ["props", "value", "user_id", "event_id", "event_type"]),
    ]
    for number, (rows, columns) in enumerate(arrivals):
        export(rows.select(*columns), f"{root}/in/{number}", "csv")
        ingest = ingester(spark, root, "csv", reader_options={"escape": '"'})
        ingested = drain(ingest, root)
    return ingested.select("event_id", "user_id", "value", "event_type", "props")


@query("ingest_restart_exactly_once", "select event_id, user_id, event_type, value from events")
def ingest_restart_exactly_once(spark, folder):
    """Files arrive in two portions; a third start finds nothing new."""
    root = scratch(spark, "ingest-restart")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    early = F.col("event_type").isin("click", "view")
    events.where(early).write.mode("append").json(f"{root}/in")
    drain(ingester(spark, root, "json", max_files_per_trigger=1), root)
    events.where(~early).write.mode("append").json(f"{root}/in")
    drain(ingester(spark, root, "json", max_files_per_trigger=1), root)
    return drain(ingester(spark, root, "json"), root)


def spoiled_lines(spark, folder):
    """Events as JSON lines; every signup is cut off in the middle."""
    record = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    cut = F.when(F.col("event_type") == "signup", F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "us')))
    return table(spark, folder, "events").select(F.coalesce(cut, record).alias("value"))


@query(
    "malformed_permissive",
    """select case when event_type <> 'signup' then event_id end as event_id,
              case when event_type <> 'signup' then user_id end as user_id,
              case when event_type = 'signup' then '{"event_id": ' || event_id || ', "us' end as corrupt from events""",
)
def malformed_permissive(spark, folder):
    root = scratch(spark, "ingest-permissive")
    spoiled_lines(spark, folder).write.text(f"{root}/in")
    rows = drain(ingester(spark, root, "json", mode="PERMISSIVE", add_new_columns=False), root)
    return rows.select("event_id", "user_id", F.col("_corrupt_record").alias("corrupt"))


@query("malformed_drop", "select event_id, user_id, event_type, value from events where event_type <> 'signup'")
def malformed_drop(spark, folder):
    root = scratch(spark, "ingest-drop")
    spoiled_lines(spark, folder).write.text(f"{root}/in")
    rows = drain(ingester(spark, root, "json", mode="DROPMALFORMED"), root)
    return rows.select("event_id", "user_id", "event_type", "value")


@query(
    "rescue_misfits",
    """select case when event_type <> 'error' then event_id end as event_id, user_id,
              case when event_type = 'error' then 'E' || event_id end as rescued_id,
              case when event_type = 'view' then event_type end as rescued_kind from events""",
)
def rescue_misfits(spark, folder):
    """Ids of errors are no numbers, and views bring a field that the schema does not have."""
    root = scratch(spark, "ingest-rescue")
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    plain = F.to_json(F.struct("event_id", "user_id"))
    bad_id = F.to_json(F.struct(F.concat(F.lit("E"), F.col("event_id")).alias("event_id"), "user_id"))
    extra = F.to_json(F.struct("event_id", "user_id", F.col("event_type").alias("kind")))
    events.where(~kind.isin("error", "view")).select(plain.alias("value")).write.text(f"{root}/in/0")
    ingest = ingester(spark, root, "json", mode="PERMISSIVE", add_new_columns=False)
    drain(ingest, root)
    late = F.when(kind == "error", bad_id).otherwise(extra)
    events.where(kind.isin("error", "view")).select(late.alias("value")).write.text(f"{root}/in/1")
    rows = drain(ingest, root)
    return rows.select(
        "event_id",
        "user_id",
        F.get_json_object("_rescued_data", "$.event_id").alias("rescued_id"),
        F.get_json_object("_rescued_data", "$.kind").alias("rescued_kind"),
    )


def _widening(spark, folder, fmt):
    """Whole numbers first, then fractions; nothing that is sound may be dropped for it."""
    root = scratch(spark, f"ingest-widening-{fmt}")
    events = table(spark, folder, "events")
    fractions = F.col("event_type").isin("click", "error")
    whole = events.where(~fractions).select("event_id", F.floor("value").alias("amount"))
    export(whole, f"{root}/in/0", fmt)
    drain(ingester(spark, root, fmt, mode="DROPMALFORMED"), root)
    export(events.where(fractions).select("event_id", F.col("value").alias("amount")), f"{root}/in/1", fmt)
    return drain(ingester(spark, root, fmt, mode="DROPMALFORMED"), root).select(
        "event_id", F.col("amount").cast("double").alias("amount")
    )


WIDER_SQL = "select event_id, case when event_type in ('click', 'error') then value else floor(value) end as amount from events"


@query("ingest_type_widening_json", WIDER_SQL)
def ingest_type_widening_json(spark, folder):
    return _widening(spark, folder, "json")


@query("ingest_type_widening_csv", WIDER_SQL)
def ingest_type_widening_csv(spark, folder):
    return _widening(spark, folder, "csv")


@query(
    "ingest_type_widening_parquet",
    """select event_id, case when event_type = 'click' then value when event_type <> 'error' then floor(value) end as amount,
              case when event_type = 'error' then 'E' || event_id end as rescued from events""",
)
def ingest_type_widening_parquet(spark, folder):
    """Whole numbers, fractions, and text where numbers are logged, which is rescued though columns may be added."""
    root = scratch(spark, "ingest-widening-parquet")
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    values = [
        (~kind.isin("click", "error"), F.floor("value")),
        (kind == "click", F.col("value")),
        (kind == "error", F.concat(F.lit("E"), F.col("event_id"))),
    ]
    for number, (chosen, amount) in enumerate(values):
        events.where(chosen).select("event_id", amount.alias("amount")).write.parquet(f"{root}/in/{number}")
        rows = drain(ingester(spark, root, "parquet"), root)
    return rows.select("event_id", "amount", F.get_json_object("_rescued_data", "$.amount").alias("rescued"))


@query(
    "rescue_adding_columns",
    """select case when event_type <> 'error' then event_id end as event_id, user_id,
              case when event_type = 'view' then event_type end as kind,
              case when event_type = 'error' then 'E' || event_id end as rescued_id from events""",
)
def rescue_adding_columns(spark, folder):
    """A new field becomes a column, and ids that are no numbers are rescued, in one run."""
    root = scratch(spark, "ingest-rescue-adding")
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    events.where(~kind.isin("error", "view")).select("event_id", "user_id").write.json(f"{root}/in/0")
    drain(ingester(spark, root, "json", mode="PERMISSIVE"), root)
    bad = F.to_json(F.struct(F.concat(F.lit("E"), F.col("event_id")).alias("event_id"), "user_id"))
    extra = F.to_json(F.struct("event_id", "user_id", kind.alias("kind")))
    late = F.when(kind == "error", bad).otherwise(extra)
    events.where(kind.isin("error", "view")).select(late.alias("value")).write.text(f"{root}/in/1")
    rows = drain(ingester(spark, root, "json", mode="PERMISSIVE"), root)
    return rows.select("event_id", "user_id", "kind", F.get_json_object("_rescued_data", "$.event_id").alias("rescued_id"))
