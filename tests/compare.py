"""Run registered queries against their SQL on DuckDB: python tests/compare.py [sf] [query ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


def kinds(columns, data):
    """Python type per column of the first rows that are not null."""
    found = {}
    for row in data[:200]:
        for name, value in zip(columns, row):
            if value is not None and name not in found:
                found[name] = type(value).__name__
    return dict(sorted(found.items()))


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def compare(spark, con, sf: str, name: str, query, oracle: str | None) -> tuple[str, int]:
    """('', rows) when equal, else a description of the first difference."""
    df = query(spark, sf)
    data = [tuple(row) for row in df.collect()]
    if oracle is None:
        return ("" if data else "no rows"), len(data)
    result = con.execute(oracle)
    columns = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(data)
    left, right = kinds(df.columns, data), kinds(columns, expected)
    if left != right:
        return f"types {left} != {right}", len(data)
    got, want = rows(df.columns, data), rows(columns, expected)
    if got != want:
        only = [row for row in got if row not in set(want)][:2], [row for row in want if row not in set(got)][:2]
        return f"{len(got)} rows != {len(want)} rows; only here {only[0]}; only there {only[1]}", len(data)
    return "", len(data)


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    import __spark_entry__ as entry

    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark, con = session(), connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            problem, count = compare(spark, con, sf, name, queries[name], oracle.get(name))
        except Exception as error:
            problem, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += bool(problem)
        mark = "FAIL" if problem else "ok" if name in oracle else "rows"
        print(f"{mark:5} {name:28} {count:7} rows {time.time() - began:6.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
