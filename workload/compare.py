"""Compare registered queries with their SQL: ``python -m workload.compare [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES


def local_session(cores: str = "8", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        # Building a plan takes a third of the time without call site capture.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    """Rows as a multiset with the columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(frame: DataFrame) -> Counter:
    return bag(frame.columns, [tuple(row) for row in frame.collect()])


def duck_bag(connection: duckdb.DuckDBPyConnection, sql: str) -> Counter:
    cursor = connection.execute(sql)
    return bag([column[0] for column in cursor.description], cursor.fetchall())


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.monotonic()
        frame = QUERIES[name](spark, sf_dir)
        found = spark_bag(frame)
        seconds = time.monotonic() - start
        if name not in ORACLE:
            print(f"{name}: {found.total()} rows, no SQL ({seconds:.1f}s)")
            continue
        expected = duck_bag(connection, ORACLE[name])
        cursor = connection.execute(ORACLE[name])
        same_names = sorted(frame.columns) == sorted(column[0] for column in cursor.description)
        same = found == expected and same_names
        failed += not same
        print(f"{name}: {found.total()} rows, {'equal' if same else 'DIFFERENT'} ({seconds:.1f}s)")
        if not same:
            print("  columns", sorted(frame.columns), "rows expected", expected.total())
            print("  only Spark", list((found - expected).items())[:2])
            print("  only SQL  ", list((expected - found).items())[:2])
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
