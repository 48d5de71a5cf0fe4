"""Compare registered queries with their SQL run by DuckDB.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time



def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normal(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if value != value else repr(value)
    return str(value)


def as_rows(table) -> tuple[list[tuple], dict[str, str]]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = sorted(tuple(normal(v) for v in row) for row in zip(*columns)) if names else []
    return rows, {n: str(table.schema.field(n).type) for n in names}


def differences(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got, got_types = as_rows(frame.toArrow())
    want, want_types = as_rows(connection.sql(sql).to_arrow_table())
    if list(got_types) != list(want_types):
        return f"columns {list(got_types)} and {list(want_types)}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    if got != want:
        only = [r for r in got if r not in set(want)][:3]
        other = [r for r in want if r not in set(got)][:3]
        return f"values: ours {only}, SQL {other}"
    if {k: v.replace("large_", "") for k, v in got_types.items()} != {
        k: v.replace("large_", "") for k, v in want_types.items()
    }:
        return f"types: ours {got_types}, SQL {want_types}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry_points

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = duck(folder)
    sql = entry_points.oracle_sql()
    bad = 0
    for name, run in entry_points.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        started = time.time()
        try:
            frame = run(spark, folder)
            if name in sql:
                problem = differences(frame, connection, sql[name])
                note = "equal" if problem is None else f"DIFFERENT {problem}"
            else:
                problem, note = None, f"{frame.count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problem = str(error)
            note = f"FAILED {type(error).__name__}: {problem[:700]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s  {note}", flush=True)
    print(f"{bad} of {len(entry_points.queries())} with problems")
    return bad


if __name__ == "__main__":
    sys.exit(main())
