"""Runs registered queries next to their SQL on the same files and compares schema names and values.

    python tests/oracle_check.py [sf] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else round(value, 6)
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, name: str, query, sql: str | None, connection, sf_dir: str) -> str:
    started = time.time()
    df = query(spark, sf_dir)
    got = normal(df.columns, df.collect())
    spent = time.time() - started
    if sql is None:
        return f"rows  {name}: {len(got[1])} rows, {spent:.1f}s"
    started = time.time()
    result = connection.execute(sql)
    want = normal([item[0] for item in result.description], result.fetchall())
    oracle = time.time() - started
    if got[0] != want[0]:
        return f"FAIL  {name}: columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        left = sorted(set(got[1]) - set(want[1]), key=repr)[:3]
        right = sorted(set(want[1]) - set(got[1]), key=repr)[:3]
        return f"FAIL  {name}: {len(got[1])} rows, want {len(want[1])}\n  only spark {left}\n  only sql   {right}"
    return f"ok    {name}: {len(got[1])} rows, spark {spent:.1f}s, sql {oracle:.1f}s"


def main() -> None:
    import __spark_entry__ as registered
    from assetpulse.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = build_session(
        "oracle-check",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    connection = connect(sf_dir)
    sql = registered.oracle_sql()
    bad = 0
    for name, query in registered.queries().items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, name, query, sql.get(name), connection, sf_dir)
        except Exception as error:  # keep going: one report for all queries
            line = f"FAIL  {name}: {type(error).__name__} {str(error)[:1500]}"
        bad += line.startswith("FAIL")
        print(line, flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
