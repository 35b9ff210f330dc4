"""Run registered queries against DuckDB and report differences."""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import QUERIES
from checks.oracle import ORACLE_SQL


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str:
    """Empty when Spark and DuckDB return the same columns and the same rows."""
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    ours = Counter(tuple(row) for row in result.select(*columns).collect())
    expected = connection.execute(ORACLE_SQL[name])
    names = [item[0] for item in expected.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(column) for column in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    if ours == theirs:
        return ""
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(only_ours.values())} rows only here, {sum(only_theirs.values())} only there; "
        f"e.g. {next(iter(only_ours), None)} / {next(iter(only_theirs), None)}"
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        found = difference(spark, connection, name, sf_dir) if name in ORACLE_SQL else "no SQL"
        print(f"{name:32s} {time.time() - start:6.2f}s  {found or 'same'}", flush=True)


if __name__ == "__main__":
    main()
