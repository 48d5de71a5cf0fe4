"""Command lines: ``python -m tidemark.cli ingest ...`` and ``python -m tidemark.cli rides ...``."""

from __future__ import annotations

import argparse
import json
import os

from tidemark.session import build_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="drain a directory into a table")
    ingest.add_argument("source_path")
    ingest.add_argument("table_name")
    ingest.add_argument("--format", default="csv")
    ingest.add_argument("--checkpoint-path", required=True)
    ingest.add_argument("--schema-location", required=True)
    ingest.add_argument("--table-location")
    ingest.add_argument("--max-files", type=int, default=1000)
    ingest.add_argument("--mode", default="FAILFAST")
    ingest.add_argument("--rescue", action="store_true", help="keep new columns in _rescued_data")

    rides = jobs.add_parser("rides", help="update the ride KPI tables from an event log")
    rides.add_argument("output")
    rides.add_argument("--servers", help="Kafka bootstrap servers")
    rides.add_argument("--topic")
    rides.add_argument("--path", help="directory of text files instead of a broker")
    rides.add_argument("--jaas-variable", default="TIDEMARK_KAFKA_JAAS", help="environment variable with the login line")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"tidemark-{args.job}")
    try:
        if args.job == "ingest":
            from tidemark.plans.file_ingest import run_file_ingest
            from tidemark.streaming.ingester import IngestConfig

            config = IngestConfig(
                source_path=args.source_path,
                checkpoint_path=args.checkpoint_path,
                schema_location=args.schema_location,
                file_format=args.format,
                add_new_columns=not args.rescue,
                max_files_per_trigger=args.max_files,
                mode=args.mode,
                table_location=args.table_location,
            )
            print(json.dumps(run_file_ingest(spark, config, args.table_name), default=str))
        else:
            from tidemark.plans.ride_kpis import KpiSinks, run_ride_kpis
            from tidemark.sources.event_log import EventLog, broker

            if args.path:
                log = EventLog("text", args.path)
            elif args.servers and args.topic:
                log = broker(args.servers, args.topic, jaas=os.environ.get(args.jaas_variable))
            else:
                raise SystemExit("give --path, or --servers and --topic")
            run_ride_kpis(spark, log, KpiSinks(args.output))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
