"""Compare registered queries with their SQL: ``python tests/compare.py <folder> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value)
    if isinstance(value, (int, bool)):
        return str(value)
    return repr(value)


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, df.collect())
    if actual == expected:
        return ""
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra)[:3]}, missing {list(missing)[:3]}"
    )


def local_session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, chosen: list[str]) -> int:
    from orderstream.plans.catalog import QUERIES
    from orderstream.plans.oracle import ORACLE

    spark, con, bad = local_session(), duck(sf_dir), 0
    for name in chosen or QUERIES:
        begun = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
