"""Runs queries next to their SQL on one table folder and compares the results exactly.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(columns: list[str], records: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(repr(record[i]) for i in order) for record in records)


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    result = QUERIES[name](spark, sf_dir)
    got = [tuple(row) for row in result.collect()]
    cursor = connection.execute(ORACLE_SQL[name])
    columns = [column[0] for column in cursor.description]
    want = cursor.fetchall()
    if sorted(result.columns) != sorted(columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    left, right = _rows(result.columns, got), _rows(columns, want)
    if left != right:
        return (f"{len(got)} rows against {len(want)}; only here {list((left - right).items())[:2]}, "
                f"only there {list((right - left).items())[:2]}")
    return None if got else "no rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        problem = difference(spark, connection, sf_dir, name)
        failed += problem is not None
        print(f"{name:30s} {time.perf_counter() - start:6.2f}s {problem or 'agrees'}", flush=True)
    return min(failed, 1)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
