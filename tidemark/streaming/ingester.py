"""Incremental ingestion of a growing directory, with schema evolution."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import schema_findings
from tidemark.sinks import paths
from tidemark.sinks.batch import SchemaMismatch
from tidemark.sinks.streams import append_to_path, append_to_table, checkpoint_for, each_batch
from tidemark.sources.file_batches import FileBatch
from tidemark.sources.rescue import rescue_json
from tidemark.sources.schema_log import SchemaLog, holds, merge, promote, raise_to, retyped
from tidemark.streaming import progress

BATCH = "_batch_id"
DEFAULT_FILES_PER_BATCH = 5000

Transform = Callable[[DataFrame], DataFrame]


def object_store_uri(account: str, container: str, directory: str = "", scheme: str = "abfss") -> str:
    """URI of a container or a directory in it, without a trailing slash."""
    return f"{scheme}://{container}@{account}/{directory}".rstrip("/")


@dataclass(frozen=True)
class IngestConfig:
    """What to read, and where the ingest keeps its state."""

    source_path: str
    checkpoint_path: str
    schema_location: str
    file_format: str = "csv"
    add_new_columns: bool = True
    merge_schema: bool = True
    infer_schema: bool = True
    recursive: bool = True
    max_files_per_trigger: int | None = None
    mode: str = "FAILFAST"
    sampling_ratio: float = 1.0
    table_location: str | None = None
    reader_options: Mapping[str, str] = field(default_factory=dict)  # such as the CSV dialect


class FileIngester:
    """Reads files of a directory once each and appends their rows to a table or path.

    The schema of a streaming DataFrame is fixed when it starts, so rows cannot
    gain columns while it runs. The stream therefore carries the names of new
    files, and each micro-batch reads its files with the schema as it is then:
    columns of the newest file appear at once and older rows have NULL there.
    Every micro-batch owns the partition ``_batch_id`` of the target; a replayed
    batch replaces it, so no row is written twice.
    """

    def __init__(self, spark: SparkSession, config: IngestConfig):
        self.spark = spark
        self.config = config
        self.log = SchemaLog(spark, config.schema_location)
        self.query: StreamingQuery | None = None
        self._rows: DataFrame | None = None
        self.batches = FileBatch(
            spark,
            config.file_format,
            self.log,
            config.mode,
            config.add_new_columns,
            config.infer_schema,
            config.sampling_ratio,
            config.reader_options,
        )

    # -- reading ---------------------------------------------------------------

    def _files_per_batch(self) -> int:
        return self.config.max_files_per_trigger or DEFAULT_FILES_PER_BATCH

    def _options(self) -> dict[str, str]:
        return {
            "recursiveFileLookup": str(self.config.recursive).lower(),
            "maxFilesPerTrigger": str(self._files_per_batch()),
        }

    def read_files(self) -> DataFrame:
        """The stream of new files; their content is never read here."""
        listing = "path string, modificationTime timestamp, length bigint, content binary"
        files = self.spark.readStream.format("binaryFile").schema(listing).options(**self._options())
        return files.load(self.config.source_path).select("path", "modificationTime", "length")

    def read_stream(self, refresh: bool = False) -> DataFrame:
        """Typed rows with the logged schema, or at first with that of the files present.

        Handed to a writer unchanged, it is ingested file by file and may gain
        columns on the way; a writer that gets no DataFrame does the same and
        saves the look at all files. A DataFrame derived from it keeps this schema,
        and JSON fields that are new wait in ``_rescued_data``, until a start with
        ``refresh``, which infers from the whole directory again.
        """
        schema = self.log.latest()
        if schema is None or refresh:
            schema = self.batches.discover(self.config.source_path, self.config.recursive)
        reader = self.spark.readStream.options(**self._options())
        fmt = self.config.file_format.lower()
        if fmt == "json":
            rows = rescue_json(reader.text(self.config.source_path), schema)
            rows = self.batches.checked(rows, rows.columns[:-1])
        elif fmt == "csv":
            # a header that differs from the schema is an error, not a mix-up of columns
            options = {"header": "true", "enforceSchema": "false", "mode": self.config.mode}
            rows = reader.schema(schema).options(**options, **self.config.reader_options).csv(self.config.source_path)
        else:
            rows = reader.schema(schema).format(fmt).load(self.config.source_path)
        self._rows = rows
        return rows

    # -- writing ---------------------------------------------------------------

    def _load(self, listing: DataFrame, number: int, transform: Transform | None) -> DataFrame | None:
        files = [r["path"] for r in listing.select("path").collect()]  # bounded by the trigger's file limit
        if not files:
            return None
        rows = self.batches.read(files)
        return transform(rows) if transform else rows

    def _is_unchanged(self, df: DataFrame | None) -> bool:
        return df is None or df is self._rows

    def _accept(self, rows: DataFrame, known: T.StructType | None) -> None:
        """Refuse new columns and wider types of the target unless merging is on, and types that cannot be raised."""
        if known is None:
            return
        findings = schema_findings(rows.schema, known)
        merging = self.config.merge_schema
        clashing = {f.name for f in rows.schema.fields if f.name in known.names and not holds(promote(known[f.name].dataType, f.dataType), f.dataType)}
        refused = [f for f in findings if (f[1] == "mistyped" and (f[0] in clashing or not merging)) or (f[1] == "extra" and not merging)]
        if refused:
            raise SchemaMismatch("; ".join(f"{name}: {what} ({want} to {got})" for name, what, want, got in refused))

    def write_to_path(
        self,
        df: DataFrame | None = None,
        output_path: str = "",
        mode: str = "append",
        trigger_type: str = "processingTime",
        processing_time: str = "10 seconds",
        transform: Transform | None = None,
    ) -> StreamingQuery:
        """Append to parquet files under ``output_path``."""
        self._only_append(mode)
        checkpoint = checkpoint_for(self.config.checkpoint_path, output_path)
        if not self._is_unchanged(df):
            self.query = append_to_path(df, output_path, checkpoint, "parquet", trigger_type, processing_time)
            return self.query
        target = SchemaLog(self.spark, f"{checkpoint}-target-schema")

        def write(listing: DataFrame, number: int) -> None:
            rows = self._load(listing, number, transform)
            if rows is not None:
                self._accept(rows, target.latest())
                wanted = target.evolve(rows.schema, widen=False, reserved=True, since=number)
                rows = raise_to(rows, T.StructType([wanted[c] for c in rows.columns]))
                rows.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/{BATCH}={number}")

        self.query = each_batch(self.read_files(), write, "append", checkpoint, trigger_type, processing_time)
        return self.query

    def write_to_table(
        self,
        df: DataFrame | None = None,
        table_name: str = "",
        mode: str = "append",
        trigger_type: str = "processingTime",
        processing_time: str = "10 seconds",
        transform: Transform | None = None,
    ) -> StreamingQuery:
        """Append to a catalog table, which gains columns as files do."""
        self._only_append(mode)
        checkpoint = checkpoint_for(self.config.checkpoint_path, table_name)
        base = self.config.table_location or self.spark.conf.get("spark.sql.warehouse.dir")
        base = f"{base.rstrip('/')}/{table_name}"
        if not self._is_unchanged(df):
            self.query = append_to_table(df, table_name, checkpoint, base, "parquet", trigger_type, processing_time)
            return self.query

        def write(listing: DataFrame, number: int) -> None:
            rows = self._load(listing, number, transform)
            if rows is None:
                return
            fields = [f for f in rows.schema.fields if f.name != BATCH]
            if self.spark.catalog.tableExists(table_name):
                known = T.StructType([f for f in self.spark.table(table_name).schema.fields if f.name != BATCH])
                self._accept(rows, known)
                wanted = merge(known, rows.schema)
                if retyped(known, wanted):
                    self._retype(table_name, base, wanted, number)
                fresh = [f for f in fields if f.name not in known.names]
                if fresh and not retyped(known, wanted):
                    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
                    self.spark.sql(f"ALTER TABLE {table_name} ADD COLUMNS ({added})")
                rows = raise_to(rows, T.StructType([wanted[f.name] for f in fields]))
            else:
                self._create(table_name, base, fields)
            rows.write.mode("overwrite").parquet(f"{self._location(base)}/{BATCH}={number}")
            self.spark.sql(f"ALTER TABLE {table_name} ADD IF NOT EXISTS PARTITION ({BATCH}={number})")
            self.spark.catalog.refreshTable(table_name)

        self.query = each_batch(self.read_files(), write, "append", checkpoint, trigger_type, processing_time)
        return self.query

    def _location(self, base: str) -> str:
        """Where the rows of a table are: beside ``base`` once a type has changed."""
        moved = f"{base}.moved"
        return paths.read_small(self.spark, moved) if paths.exists(self.spark, moved) else base

    def _create(self, name: str, base: str, fields: Sequence[T.StructField]) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        location = self._location(base)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) LOCATION '{location}'"
        )
        if paths.children(self.spark, location):
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def _retype(self, name: str, base: str, wanted: T.StructType, number: int) -> None:
        """Copy a table whose column gets a wider type; its old files stay until the new ones are named.

        Files of two types cannot be one catalog table, so this costs a pass over the
        table, once for each change. A path as target needs none.
        """
        location = f"{base}.from-batch-{number}"
        rows = self.spark.table(name)
        raised = raise_to(rows, T.StructType([*wanted.fields, rows.schema[BATCH]]))
        raised.hint("rebalance", F.col(BATCH)).write.mode("overwrite").partitionBy(BATCH).parquet(location)
        paths.put(self.spark, f"{base}.moved", location)
        self.spark.sql(f"DROP TABLE {name}")
        self._create(name, base, wanted.fields)

    @staticmethod
    def _only_append(mode: str) -> None:
        if mode != "append":
            raise ValueError(f"ingested files are appended; for {mode} output use tidemark.sinks.streams")

    def read_output(self, output_path: str) -> DataFrame:
        """What was written to a path so far, in the widest schema and types, without the batch number."""
        checkpoint = checkpoint_for(self.config.checkpoint_path, output_path)
        epochs = SchemaLog(self.spark, f"{checkpoint}-target-schema").epochs()
        if not epochs:
            raise ValueError(f"nothing has been written to {output_path}")
        together = None
        for (first, schema), (after, _) in zip(epochs, [*epochs[1:], (None, None)]):
            # batches of other types than the newest are read with their own and raised
            rows = self.spark.read.schema(schema).parquet(output_path).where(F.col(BATCH) >= first)
            if after is not None:
                rows = rows.where(F.col(BATCH) < after)
            rows = raise_to(rows, epochs[-1][1])
            together = rows if together is None else together.union(rows)
        return together

    # -- the running query -----------------------------------------------------

    def get_stream_status(self) -> dict[str, Any]:
        return progress.status(self.query)

    def stop_stream(self, await_termination: bool = True) -> None:
        progress.stop(self.query, await_termination)

    def await_termination(self, timeout_seconds: float | None = None) -> bool:
        """Wait for the end; with a timeout, tell whether it came in time."""
        if self.query is None:
            return True
        if timeout_seconds is None:
            self.query.awaitTermination()
            return True
        return bool(self.query.awaitTermination(timeout_seconds))


def create_ingester(
    spark: SparkSession,
    source_path: str | None = None,
    file_format: str = "csv",
    storage_account: str | None = None,
    container: str | None = None,
    directory: str = "",
    **config: Any,
) -> FileIngester:
    """An ingester for a path, or for a container of a storage account."""
    if source_path is None:
        if not (storage_account and container):
            raise ValueError("give a source_path, or a storage_account and a container")
        source_path = object_store_uri(storage_account, container, directory)
    if "checkpoint_path" not in config or "schema_location" not in config:
        from tidemark.session import shared_folder

        base = checkpoint_for(f"{shared_folder(spark)}/tidemark/ingest", source_path)
        config.setdefault("checkpoint_path", f"{base}/checkpoints")
        config.setdefault("schema_location", f"{base}/schema")
    return FileIngester(spark, IngestConfig(source_path=source_path, file_format=file_format, **config))
