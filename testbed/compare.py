"""Run queries on Spark and their SQL on DuckDB and compare the two results.

    python -m testbed.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from pathgauge.session import session
from testbed.oracles import ORACLES
from testbed.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    return float(value) + 0.0


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def compare(spark, db, name: str, sf_dir: str) -> tuple[int, str, float, float]:
    """Row count, first difference (empty when equal), seconds on Spark, seconds on DuckDB."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    spark_time = time.time() - start
    start = time.time()
    cursor = db.execute(ORACLES[name])
    other = _rows([c[0] for c in cursor.description], cursor.fetchall())
    sql_time = time.time() - start
    problem = ""
    if mine[0] != other[0]:
        problem = f"columns {mine[0]} != {other[0]}"
    elif len(mine[1]) != len(other[1]):
        problem = f"rows {len(mine[1])} != {len(other[1])}"
    elif mine[1] != other[1]:
        different = [(a, b) for a, b in zip(mine[1], other[1]) if a != b]
        problem = f"{len(different)} rows differ, first {different[0]}"
    return len(mine[1]), problem, spark_time, sql_time


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failures = 0
    for name in arguments[1:] or QUERIES:
        try:
            rows, problem, took, sql = compare(spark, db, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            rows, problem, took, sql = 0, f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0.0
        failures += bool(problem)
        print(f"{name:20} {rows:8} rows {took:6.2f}s spark {sql:6.2f}s sql  {problem or 'ok'}", flush=True)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
