"""Compare every registered query with its SQL: ``python -m checks.compare [sf_dir] [name ...]``"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value.item() if hasattr(value, "item") else value


def row_counts(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(_plain(row[i]) for i in order) for row in rows),
    )


def differences(df: DataFrame, connection, sql: str) -> tuple[int, str | None]:
    """Row count and the first difference found, if any."""
    got_columns, got = row_counts(df.columns, df.toLocalIterator())
    result = connection.execute(sql)
    want_columns, want = row_counts([d[0] for d in result.description], result.fetchall())
    total = sum(got.values())
    if got_columns != want_columns:
        return total, f"columns {got_columns} instead of {want_columns}"
    if got != want:
        more, less = got - want, want - got
        return total, (
            f"{sum(more.values())} rows too many, {sum(less.values())} missing; "
            f"e.g. {next(iter(more), None)} / {next(iter(less), None)}"
        )
    return total, None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        begun = time.time()
        rows, problem = differences(QUERIES[name](spark, sf_dir), connection, ORACLE_SQL[name])
        bad += problem is not None
        print(f"{name:22} {rows:8} rows {time.time() - begun:6.2f}s {problem or 'same'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} the same")


if __name__ == "__main__":
    main()
