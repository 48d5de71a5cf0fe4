"""Reading one bounded set of files with a schema that may have grown since the last."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.typing import convert
from tidemark.sinks import paths
from tidemark.sources.rescue import rescue_corrupt, rescue_json, rescue_strings
from tidemark.sources.schema_log import CORRUPT, RESCUED, SchemaLog, holds, merge, raise_to, widest

MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")
HEADERS_AT_ONCE = 32


def header_groups(spark: SparkSession, files: Sequence[str], options: Mapping[str, str]) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for each distinct CSV header among ``files``.

    Of each file only the first block is read, up to its first line end; the files
    of one trigger, which its file limit bounds, are opened side by side.
    """
    encoding = options.get("encoding", options.get("charset", "UTF-8"))
    with ThreadPoolExecutor(max_workers=HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: paths.first_line(spark, file, encoding), files))
    grouped: dict[str, list[str]] = {}
    for file, header in sorted(zip(files, headers, strict=True)):
        if header is not None:
            grouped.setdefault(header, []).append(file)
    reader = spark.read.options(**options).option("header", True)
    return [(reader.csv(grouped[header][0]).columns, grouped[header]) for header in sorted(grouped)]


class FileBatch:
    """Reads sets of files of one format with the logged schema."""

    def __init__(
        self,
        spark: SparkSession,
        fmt: str,
        log: SchemaLog,
        mode: str = "FAILFAST",
        add_new_columns: bool = True,
        infer_schema: bool = True,
        sampling_ratio: float = 1.0,
        options: Mapping[str, str] | None = None,
    ):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode}")
        self.spark = spark
        self.fmt = fmt.lower()
        self.log = log
        self.mode = mode
        self.add_new_columns = add_new_columns
        self.infer_schema = infer_schema
        self.sampling_ratio = sampling_ratio
        self.options = dict(options or {})

    def _reader(self) -> DataFrameReader:
        return self.spark.read.options(**self.options)

    def read(self, files: Sequence[str]) -> DataFrame:
        readers: dict[str, Callable[[list[str]], DataFrame]] = {"csv": self._csv, "json": self._json}
        return readers.get(self.fmt, self._by_name)(list(files))

    def discover(self, path: str, recursive: bool = True) -> T.StructType:
        """Log and return the schema of everything that is in a directory now."""
        reader = self._reader().option("recursiveFileLookup", recursive)
        if self.fmt in ("csv", "json"):
            reader = reader.option("samplingRatio", self.sampling_ratio)
        if self.fmt == "csv":
            reader = reader.option("header", True).option("inferSchema", self.infer_schema)
        elif self.fmt == "json":
            reader = reader.option("primitivesAsString", not self.infer_schema)
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        else:
            reader = reader.option("mergeSchema", True)
        return self.log.evolve(reader.format(self.fmt).load(path).schema, self.fmt in ("csv", "json"))

    def _schema(self, infer: Callable[[], T.StructType], widen: bool = True) -> T.StructType:
        """The logged schema, grown by what ``infer`` finds if growing is allowed."""
        known = self.log.latest()
        if known is not None and not self.add_new_columns:
            return known
        return self.log.evolve(infer(), widen)

    def _as_text(self, names: Sequence[str]) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    def checked(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Apply the malformed-record policy to a frame that carries ``_corrupt_record``."""
        if self.mode == "DROPMALFORMED":
            return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        if self.mode == "FAILFAST":
            message = F.concat(F.lit("malformed record: "), F.col(CORRUPT))
            passed = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
            return df.where(passed).drop(CORRUPT)
        return df.select(*columns, CORRUPT)

    # -- JSON: fields are matched by name, one object per line ----------------

    def _json(self, files: list[str]) -> DataFrame:
        def infer() -> T.StructType:
            reader = self._reader().option("samplingRatio", self.sampling_ratio)
            if not self.infer_schema:
                reader = reader.option("primitivesAsString", True)
            return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(files).schema

        schema = self._schema(infer)
        if not self.add_new_columns:
            rescued = rescue_json(self.spark.read.text(files), schema)
            return self.checked(rescued, [*schema.names, RESCUED])
        rows = self._typed(self._reader(), schema).json(files)
        if self.mode != "PERMISSIVE":
            return rows
        is_object = F.json_object_keys(CORRUPT).isNotNull()
        rescued = rescue_corrupt(rows, F.when(is_object, F.from_json(CORRUPT, "map<string,string>")), schema)
        return rescued.select(*schema.names, RESCUED, CORRUPT)

    def _typed(self, reader, schema: T.StructType):
        """Spark's own policy; PERMISSIVE keeps the text of bad records."""
        if self.mode == "PERMISSIVE":
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        return reader.schema(schema).option("mode", self.mode)

    # -- CSV: columns are matched through each file's header -------------------

    def _csv(self, files: list[str]) -> DataFrame:
        groups = header_groups(self.spark, files, self.options)

        def infer() -> T.StructType:
            seen = T.StructType()
            for names, members in groups:
                if self.infer_schema:
                    # a wide sample costs a full pass, so its size is the caller's choice
                    reader = self._reader().option("header", True).option("inferSchema", True)
                    found = reader.option("samplingRatio", self.sampling_ratio).csv(members).schema
                else:
                    found = self._as_text(names)
                seen = merge(seen, widest(found), or_text=True)
            return seen

        schema = self._schema(infer)
        together = None
        for names, members in groups:
            part = self._csv_group(names, members, schema)
            together = part if together is None else together.unionByName(part)
        return together

    def _csv_group(self, names: list[str], members: list[str], schema: T.StructType) -> DataFrame:
        reader = self._reader().option("header", True).option("enforceSchema", True)
        if not self.add_new_columns:
            text = T.StructType([*self._as_text(names).fields, T.StructField(CORRUPT, T.StringType())])
            strings = reader.schema(text).option("columnNameOfCorruptRecord", CORRUPT).csv(members)
            rescued = rescue_strings(strings, schema, carry=[CORRUPT])
            return self.checked(rescued, [*schema.names, RESCUED])
        in_file = T.StructType([schema[n] for n in names])
        rows = self._typed(reader, in_file).csv(members)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in names]
        if self.mode != "PERMISSIVE":
            return rows.select(*names, *missing).select(*schema.names)
        plain = {k: v for k, v in self.options.items() if k.lower() not in ("header", "inferschema", "samplingratio")}
        texts = F.from_csv(CORRUPT, self._as_text(names).simpleString(), plain)
        fields = F.create_map(*[x for n in names for x in (F.lit(n), texts.getField(n))])
        return rescue_corrupt(rows, fields, in_file).select(*names, *missing, RESCUED, CORRUPT).select(*schema.names, RESCUED, CORRUPT)

    # -- Parquet and ORC: typed by their own footers ---------------------------

    def _by_name(self, files: list[str]) -> DataFrame:
        """Files with the same types are read together, and their values raised to the logged types.

        A value of a type that cannot be raised is converted where it fits, else rescued.
        """
        groups = self._footers(files)

        def infer() -> T.StructType:
            seen = T.StructType()
            for found, _ in groups:
                seen = merge(seen, found)
            return seen

        schema = self._schema(infer, widen=False)
        together = None
        for found, members in groups:
            part = self._by_name_group(found, members, schema)
            together = part if together is None else together.unionByName(part, allowMissingColumns=True)
        return together

    def _footers(self, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
        """(schema, files) of each set of files whose footers Spark can merge: one set, unless a type has changed."""
        try:
            return [(self.spark.read.format(self.fmt).option("mergeSchema", True).load(files).schema, files)]
        except Exception as error:
            if len(files) == 1 or "CANNOT_MERGE" not in str(error):
                raise
        middle = len(files) // 2
        found: dict[str, tuple[T.StructType, list[str]]] = {}
        for schema, members in [*self._footers(files[:middle]), *self._footers(files[middle:])]:
            found.setdefault(schema.json(), (schema, []))[1].extend(members)
        return list(found.values())

    def _by_name_group(self, found: T.StructType, files: list[str], schema: T.StructType) -> DataFrame:
        rows = self.spark.read.format(self.fmt).schema(found).load(files)
        lost = {c: F.col(f"`{c}`") for c in found.names if c not in schema.names}
        converted = {}
        for field in found.fields:
            if field.name not in schema.names or holds(schema[field.name].dataType, field.dataType):
                continue
            value, to = F.col(f"`{field.name}`"), schema[field.name].dataType
            if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
                lost[field.name] = value  # as a whole, beside what fits of it
            elif isinstance(field.dataType, T.NumericType) and isinstance(to, T.NumericType):
                fresh = value.try_cast(to)
                converted[field.name] = F.when(fresh.try_cast(field.dataType) == value, fresh)
            else:
                converted[field.name] = convert(value.cast("string"), to.simpleString())
        for name, fresh in converted.items():
            lost[name] = F.when(fresh.isNull(), F.col(f"`{name}`"))
        rescued = F.lit(None).cast("string")
        if lost:
            named = [x for c, v in lost.items() for x in (F.lit(c), F.when(v.isNotNull(), self._text(v, found[c].dataType)))]
            texts = F.map_filter(F.create_map(*named), lambda _, v: v.isNotNull())
            rescued = F.when(F.size(texts) > 0, F.to_json(texts))
        wanted = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
        typed = raise_to(rows.withColumns({RESCUED: rescued, **converted}), wanted)
        return typed if lost or not self.add_new_columns else typed.drop(RESCUED)

    @staticmethod
    def _text(value: Column, kind: T.DataType) -> Column:
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(value) if nested else value.cast("string")
