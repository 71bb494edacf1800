"""Run registered queries on Spark and their SQL on DuckDB and compare whole results.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    """One spelling per value: floats by 12 significant digits, dates and times as text."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None if both sides agree, else a short report."""
    frame = query(spark, sf_dir)
    mine = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(set(frame.columns) ^ set(names))}"
    if not mine:
        return "no rows"
    if mine == theirs:
        return None
    only_mine = [row for row in mine if row not in set(theirs)][:3]
    only_theirs = [row for row in theirs if row not in set(mine)][:3]
    return f"{len(mine)} vs {len(theirs)} rows of {sorted(names)}\n  spark: {only_mine}\n  sql:   {only_theirs}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            report = compare(spark, connection, query, sqls[name], sf_dir) if name in sqls else "no SQL"
        except Exception as error:
            report = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += report is not None
        print(f"{name}: {report or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failed} not matching")


if __name__ == "__main__":
    main()
