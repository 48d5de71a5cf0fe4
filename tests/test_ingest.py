"""File ingestion: evolution, rescue, malformed records, restarts, tables."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import cli
from tidemark.plans.file_ingest import run_file_ingest, run_together
from tidemark.sinks import paths
from tidemark.sinks.batch import SchemaMismatch
from tidemark.session import unique_name
from tidemark.sources.rescue import rescue_json
from tidemark.sources.file_batches import header_groups
from tidemark.sources.schema_log import SchemaLog, holds, merge, promote
from tidemark.streaming.ingester import FileIngester, IngestConfig, create_ingester, object_store_uri


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(folder, name, text):
    path = f"{folder}/in/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    stamp = time.time() - 5000 + 10 * len([n for _, _, names in os.walk(f"{folder}/in") for n in names])
    os.utime(path, (stamp, stamp))


def make(spark, folder, fmt="csv", **options):
    config = IngestConfig(
        source_path=f"{folder}/in", checkpoint_path=f"{folder}/c", schema_location=f"{folder}/s",
        table_location=f"{folder}/tables", file_format=fmt, **options,
    )
    return FileIngester(spark, config)


def drain(ingester, folder):
    ingester.write_to_path(output_path=f"{folder}/out", trigger_type="availableNow")
    ingester.await_termination()
    return ingester.read_output(f"{folder}/out")


def test_config_defaults_and_uris(spark):
    config = IngestConfig("p", "c", "s")
    assert (config.file_format, config.add_new_columns, config.merge_schema, config.infer_schema) == ("csv", True, True, True)
    assert (config.recursive, config.max_files_per_trigger, config.mode) == (True, None, "FAILFAST")
    assert object_store_uri("a.dfs.core.windows.net", "raw", "events/") == "abfss://raw@a.dfs.core.windows.net/events"
    assert object_store_uri("a.dfs.core.windows.net", "raw") == "abfss://raw@a.dfs.core.windows.net"
    made = create_ingester(spark, storage_account="a", container="b", file_format="json", mode="PERMISSIVE")
    assert made.config.source_path == "abfss://b@a" and made.config.mode == "PERMISSIVE"
    assert made.config.checkpoint_path.endswith("/checkpoints")
    assert made.get_stream_status() == {"status": "No active query"}
    made.stop_stream()
    assert made.await_termination(1) is True
    with pytest.raises(ValueError):
        create_ingester(spark)
    with pytest.raises(ValueError, match="mode"):
        FileIngester(spark, IngestConfig("p", "c", "s", mode="LAX"))


def test_csv_columns_are_matched_by_name(spark, folder):
    put(folder, "1.csv", "id,name\n1,a\n2,b\n")
    assert rows(drain(make(spark, folder), folder)) == [(1, "a"), (2, "b")]
    put(folder, "2.csv", "name,phone,id\nc,555,3\n")
    out = drain(make(spark, folder), folder)
    assert rows(out.select("id", "name", "phone")) == [(1, "a", None), (2, "b", None), (3, "c", 555)]
    assert make(spark, folder).log.latest().simpleString() == "struct<id:bigint,name:string,phone:bigint>"


def test_columns_may_appear_within_one_run(spark, folder):
    for i, text in enumerate(["id,name\n1,a\n", "id,name,phone\n2,b,5\n", "phone,id,name,mail\n7,3,c,m\n"]):
        put(folder, f"{i}.csv", text)
    out = drain(make(spark, folder, max_files_per_trigger=1), folder)
    assert rows(out.select("id", "name", "phone", "mail")) == [(1, "a", None, None), (2, "b", 5, None), (3, "c", 7, "m")]
    history = make(spark, folder).log.history().where("version > 0")
    assert rows(history) == [(1, "phone", "added", None, "bigint"), (2, "mail", "added", None, "string")]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_evolution_by_name(spark, folder, fmt):
    spark.createDataFrame([(1, "a")], "id long, name string").coalesce(1).write.format(fmt).save(f"{folder}/in/1")
    assert rows(drain(make(spark, folder, fmt), folder)) == [(1, "a")]
    spark.createDataFrame([(2, "b", 1.5)], "id long, name string, x double").coalesce(1).write.format(fmt).save(f"{folder}/in/2")
    out = drain(make(spark, folder, fmt), folder)
    assert rows(out.select("id", "name", "x")) == [(1, "a", None), (2, "b", 1.5)]


def test_restart_reads_each_file_once(spark, folder):
    put(folder, "1.json", '{"id": 1}\n')
    put(folder, "deep/er/2.json", '{"id": 2}\n')
    for _ in range(2):
        assert rows(drain(make(spark, folder, "json"), folder)) == [(1,), (2,)]
    put(folder, "3.json", '{"id": 3}\n')
    assert rows(drain(make(spark, folder, "json"), folder)) == [(1,), (2,), (3,)]


def test_flat_listing_skips_nested_files(spark, folder):
    put(folder, "1.json", '{"id": 1}\n')
    put(folder, "deep/2.json", '{"id": 2}\n')
    assert rows(drain(make(spark, folder, "json", recursive=False), folder)) == [(1,)]


def test_a_replayed_batch_writes_no_row_twice(spark, folder):
    put(folder, "1.json", '{"id": 1}\n{"id": 2}\n')
    drain(make(spark, folder, "json"), folder)
    checkpoint = next(n for n in os.listdir(f"{folder}/c") if not n.endswith("target-schema"))
    for name in os.listdir(f"{folder}/c/{checkpoint}/commits"):
        os.remove(f"{folder}/c/{checkpoint}/commits/{name}")  # as if it died before the commit
    assert rows(drain(make(spark, folder, "json"), folder)) == [(1,), (2,)]


def test_malformed_policies(spark, folder):
    put(folder, "1.json", '{"id": 1, "n": 5}\nbroken\n{"id": 2}\n')
    kept = drain(make(spark, folder, "json", mode="PERMISSIVE"), folder)
    assert rows(kept.select("id", "n", "_corrupt_record")) == [(1, 5, None), (2, None, None), (None, None, "broken")]
    dropping = make(spark, folder + "/d", "json", mode="DROPMALFORMED")
    put(folder + "/d", "1.json", '{"id": 1}\nbroken\n{"id": 2}\n')
    assert rows(drain(dropping, folder + "/d").select("id")) == [(1,), (2,)]
    put(folder + "/f", "1.json", '{"id": 1}\nbroken\n')
    failing = make(spark, folder + "/f", "json")
    failing.write_to_path(output_path=f"{folder}/f/out", trigger_type="availableNow")
    with pytest.raises(Exception, match="(?i)malformed"):
        failing.await_termination()
    assert failing.get_stream_status()["is_active"] is False


def test_csv_malformed_policies(spark, folder):
    good, bad = "id,n\n1,5\n", "id,n\nx,6\n2,7\n"
    put(folder, "1.csv", good)
    drain(make(spark, folder, mode="DROPMALFORMED"), folder)
    put(folder, "2.csv", bad)
    assert rows(drain(make(spark, folder, mode="DROPMALFORMED"), folder)) == [(1, 5), (2, 7)]
    put(folder + "/p", "1.csv", good)
    drain(make(spark, folder + "/p", mode="PERMISSIVE"), folder + "/p")
    put(folder + "/p", "2.csv", bad)
    kept = drain(make(spark, folder + "/p", mode="PERMISSIVE"), folder + "/p")
    assert rows(kept.select("n", "_corrupt_record")) == [(5, None), (6, "x,6"), (7, None)]


def test_rescue_mode_csv(spark, folder):
    options = {"add_new_columns": False, "mode": "PERMISSIVE"}
    put(folder, "1.csv", "id,name\n1,a\n")
    drain(make(spark, folder, **options), folder)
    put(folder, "2.csv", "zip,id,name\n90,2,b\n,bad,c\n")
    out = drain(make(spark, folder, **options), folder)
    assert rows(out.select("id", "name", "_rescued_data")) == [
        (1, "a", None), (2, "b", '{"zip":"90"}'), (None, "c", '{"id":"bad"}'),
    ]


def test_rescue_mode_parquet(spark, folder):
    spark.createDataFrame([(1,)], "id long").coalesce(1).write.parquet(f"{folder}/in/1")
    drain(make(spark, folder, "parquet", add_new_columns=False), folder)
    spark.createDataFrame([(2, "z"), (3, None)], "id long, zip string").coalesce(1).write.parquet(f"{folder}/in/2")
    out = drain(make(spark, folder, "parquet", add_new_columns=False), folder)
    assert rows(out.select("id", "_rescued_data")) == [(1, None), (2, '{"zip":"z"}'), (3, None)]


def test_rescue_json_lines(spark):
    lines = ['{"id":"bad","name":"b","zip":"9"}', "nope", "[]", "", None, '{"id":3,"name":null}', '{"id":4,"deep":{"a":1}}']
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    schema = T._parse_datatype_string("id bigint, name string")
    assert rows(rescue_json(df, schema)) == sorted(
        [
            (None, "b", '{"id":"bad","zip":"9"}', None), (None, None, None, "nope"), (None, None, None, "[]"),
            (3, None, None, None), (4, None, '{"deep":"{\\"a\\":1}"}', None),
        ],
        key=str,
    )


def test_schema_merge_keeps_known_types():
    known = T._parse_datatype_string("a bigint, s struct<x: string>")
    seen = T._parse_datatype_string("b double, a string, s struct<y: int, x: bigint>")
    assert merge(known, seen).simpleString() == "struct<a:bigint,s:struct<x:string,y:int>,b:double>"


@pytest.mark.parametrize(
    ("known", "seen", "least"),
    [
        ("bigint", "double", "double"), ("double", "bigint", "double"), ("bigint", "decimal(20,0)", "decimal(20,0)"),
        ("decimal(10,2)", "bigint", "decimal(21,2)"), ("decimal(38,0)", "decimal(10,5)", "double"), ("int", "bigint", "bigint"),
        ("date", "timestamp", "timestamp"), ("timestamp_ntz", "date", "timestamp_ntz"), ("bigint", "string", "bigint"),
        ("string", "bigint", "string"), ("void", "date", "date"), ("array<int>", "array<double>", "array<double>"),
        ("struct<a:int,b:date>", "struct<a:double,c:string>", "struct<a:double,b:date,c:string>"), ("boolean", "int", "boolean"),
    ],
)
def test_types_are_promoted(known, seen, least):
    kinds = [T._parse_datatype_string(k) for k in (known, seen)]
    assert promote(*kinds).simpleString() == least
    assert holds(promote(*kinds), kinds[0])


def test_wider_numbers_lose_no_row(spark, folder):
    for fmt, first, second in (("json", '{"id": 1}\n', '{"id": 1.5}\n{"id": 2}\n'), ("csv", "id\n1\n", "id\n1.5\n2\n")):
        at = f"{folder}/{fmt}"
        for number, text in enumerate((first, second, first)):
            put(at, f"{number}.{fmt}", text)
            out = drain(make(spark, at, fmt, mode="DROPMALFORMED"), at)
        assert rows(out) == [(1.0,), (1.0,), (1.5,), (2.0,)]
        assert rows(make(spark, at, fmt).log.history().where("version > 0")) == [(1, "id", "retyped", "bigint", "double")]


def test_misfits_are_rescued_while_columns_are_added(spark, folder):
    put(folder, "1.csv", "id,n\n1,5\n")
    drain(make(spark, folder, mode="PERMISSIVE"), folder)
    put(folder, "2.csv", 'n,id,more\n6,x,"a, b"\n7,2,c\n')
    kept = drain(make(spark, folder, mode="PERMISSIVE"), folder)
    assert rows(kept.select("id", "n", "more", "_rescued_data")) == [(1, 5, None, None), (2, 7, "c", None), (None, 6, "a, b", '{"id":"x"}')]
    at = f"{folder}/j"
    put(at, "1.json", '{"id": 1}\n')
    drain(make(spark, at, "json", mode="PERMISSIVE"), at)
    put(at, "2.json", '{"id": "x", "more": 3}\nbroken\n')
    kept = drain(make(spark, at, "json", mode="PERMISSIVE"), at)
    assert rows(kept.select("id", "more", "_rescued_data", "_corrupt_record")) == [
        (1, None, None, None), (None, 3, '{"id":"x"}', '{"id": "x", "more": 3}'), (None, None, None, "broken"),
    ]


def test_parquet_files_of_several_types(spark, folder):
    for number, (kind, value) in enumerate((("int", 1), ("double", 2.5), ("string", "7"), ("string", "x"), ("bigint", 2**40))):
        spark.createDataFrame([(value,)], f"id {kind}").coalesce(1).write.parquet(f"{folder}/in/{number}")
        if number in (0, 4):  # the last four come in one batch
            out = drain(make(spark, folder, "parquet"), folder)
    assert rows(out.select("id", "_rescued_data")) == [
        (1.0, None), (2.0**40, None), (2.5, None), (7.0, None), (None, '{"id":"x"}'),
    ]
    fixed = f"{folder}/fixed"
    for number, (kind, value) in enumerate((("bigint", 1), ("double", 2.0), ("double", 2.5))):
        spark.createDataFrame([(value,)], f"id {kind}").coalesce(1).write.parquet(f"{fixed}/in/{number}")
        out = drain(make(spark, fixed, "parquet", add_new_columns=False), fixed)
    assert rows(out.select("id", "_rescued_data")) == [(1, None), (2, None), (None, '{"id":"2.5"}')]


def test_tables_gain_wider_types(spark, folder):
    name = unique_name("t")
    for number, text in enumerate(("id,n\n1,5\n", "id,n,m\n2,5.5,x\n", "id,n\n3,7\n")):
        put(folder, f"{number}.csv", text)
        run_file_ingest(spark, make(spark, folder).config, name)
    assert rows(spark.table(name).select("id", "n", "m")) == [(1, 5.0, None), (2, 5.5, "x"), (3, 7.0, None)]
    assert spark.table(name).schema["n"].dataType == T.DoubleType()
    # a crash after the old table went: the next batch finds what was copied
    spark.sql(f"DROP TABLE {name}")
    put(folder, "9.csv", "id,n,m\n9,9.5,y\n")
    run_file_ingest(spark, make(spark, folder).config, name)
    assert rows(spark.table(name).select("id", "n")) == [(1, 5.0), (2, 5.5), (3, 7.0), (9, 9.5)]


def test_headers_cost_a_block_each(spark, folder):
    long = "id,name\n" + "1,some name\n" * 400_000
    put(folder, "1.csv", long)
    put(folder, "2.csv", "name,id\nb,2\n")
    put(folder, "3.csv", "")
    with gzip.open(f"{folder}/in/4.csv.gz", "wt") as f:
        f.write("id,name\n4,z\n")
    files = [f"{folder}/in/{n}" for n in ("1.csv", "2.csv", "3.csv", "4.csv.gz")]
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getStatistics
    read = lambda: statistics("file", spark._jvm.org.apache.hadoop.fs.LocalFileSystem._java_lang_class).getBytesRead()
    before = read()
    lines = [paths.first_line(spark, f) for f in files]
    assert lines == ["id,name", "name,id", None, "id,name"] and read() - before < 4 * 64 * 1024
    groups = header_groups(spark, files, {})
    assert [(names, sorted(members)) for names, members in groups] == [
        (["id", "name"], [files[0], files[3]]), (["name", "id"], [files[1]]),
    ]


def test_schema_log_versions(spark, folder):
    log = SchemaLog(spark, f"{folder}/log")
    assert log.latest() is None
    log.evolve(T._parse_datatype_string("a int, b void"))
    log.evolve(T._parse_datatype_string("a int"))
    log.evolve(T._parse_datatype_string("c float"))
    assert log.versions() == [0, 1] and log.latest().simpleString() == "struct<a:bigint,b:string,c:double>"


def test_tables_gain_columns(spark, folder):
    name = unique_name("t")
    put(folder, "1.csv", "id,name\n1,a\n")
    status = run_file_ingest(spark, make(spark, folder).config, name)
    assert status["is_active"] is False and status["recent_progress"]["numInputRows"] == 1
    put(folder, "2.csv", "id,phone\n2,7\n")
    run_file_ingest(spark, make(spark, folder).config, name)
    assert rows(spark.table(name).select("id", "name", "phone")) == [(1, "a", None), (2, None, 7)]


def test_new_columns_are_refused_without_merging(spark, folder):
    put(folder, "1.csv", "id\n1\n")
    drain(make(spark, folder, merge_schema=False), folder)
    put(folder, "2.csv", "id,x\n2,3\n")
    ingester = make(spark, folder, merge_schema=False)
    ingester.write_to_path(output_path=f"{folder}/out", trigger_type="availableNow")
    with pytest.raises(Exception, match=SchemaMismatch.__name__):
        ingester.await_termination()


def test_rows_can_be_transformed_before_the_sink(spark, folder):
    put(folder, "1.json", '{"id": 1, "n": 10}\n{"id": 2, "n": 20}\n')
    ingester = make(spark, folder, "json", mode="PERMISSIVE")
    big = ingester.read_stream().where("n > 15").select("id", "_rescued_data")
    name = unique_name("t")
    ingester.write_to_table(big, name, trigger_type="availableNow").awaitTermination()
    put(folder, "2.json", '{"id": 3, "n": 30, "new": "x"}\n')
    again = make(spark, folder, "json", mode="PERMISSIVE")
    big = again.read_stream().where("n > 15").select("id", "_rescued_data")
    again.write_to_table(big, name, trigger_type="availableNow").awaitTermination()
    assert rows(spark.table(name)) == [(2, None), (3, '{"new":"x"}')]
    assert "new" in again.read_stream(refresh=True).columns
    evolving = make(spark, folder, "json")
    evolving.write_to_path(output_path=f"{folder}/out", trigger_type="availableNow", transform=lambda d: d.where("n > 15"))
    evolving.await_termination()
    assert rows(evolving.read_output(f"{folder}/out").select("id")) == [(2,), (3,)]


def test_two_ingests_at_once(spark, folder):
    put(folder + "/a", "1.csv", "id\n1\n")
    put(folder + "/b", "1.json", '{"id": 2}\n')
    names = unique_name("a"), unique_name("b")
    pair = [(make(spark, folder + "/a"), names[0]), (make(spark, folder + "/b", "json"), names[1])]
    assert run_together(pair, timeout=120)
    assert [rows(spark.table(n).select("id")) for n in names] == [[(1,)], [(2,)]]


def test_continuous_trigger_status_and_stop(spark, folder):
    put(folder, "1.csv", "id\n1\n")
    ingester = make(spark, folder)
    query = ingester.write_to_path(ingester.read_stream(), f"{folder}/out", processing_time="1 second")
    query.processAllAvailable()
    assert ingester.await_termination(0.1) is False
    assert ingester.get_stream_status()["is_active"]
    put(folder, "2.csv", "id,x\n2,9\n")
    query.processAllAvailable()
    ingester.stop_stream()
    assert not query.isActive
    assert rows(ingester.read_output(f"{folder}/out").select("id", "x")) == [(1, None), (2, 9)]


def test_only_append_is_offered(spark, folder):
    with pytest.raises(ValueError, match="append"):
        make(spark, folder).write_to_path(output_path="x", mode="complete")


def test_infer_nothing(spark, folder):
    put(folder, "1.csv", "id,n\n1,2\n")
    assert rows(drain(make(spark, folder, infer_schema=False), folder)) == [("1", "2")]


def test_command_line_arguments():
    args = cli.parser().parse_args(["ingest", "/in", "t", "--checkpoint-path", "/c", "--schema-location", "/s", "--rescue"])
    assert (args.job, args.format, args.max_files, args.rescue) == ("ingest", "csv", 1000, True)
    assert cli.parser().parse_args(["rides", "/out", "--path", "/log"]).path == "/log"
