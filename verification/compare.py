"""Compare every query with its SQL: python -m verification.compare <sf_dir> [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification.checks import CHECKS


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def normal_rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def normal(value):
        if value is None or value is pd.NA or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, bool) or hasattr(value, "dtype") and value.dtype == bool:
            return str(bool(value))
        return repr(float(value)) if isinstance(value, (int, float)) or hasattr(value, "dtype") else repr(value)

    return sorted(tuple(normal(value) for value in row) for row in frame.itertuples(index=False, name=None))


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What is different between Spark's and DuckDB's rows, or None."""
    check = CHECKS[name]
    ours = check.run(spark, sf_dir).toPandas()
    if check.sql is None:
        return None if len(ours) else "no rows"
    theirs = connection.execute(check.sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(theirs) == 0:
        return "the SQL has no rows"
    left, right = normal_rows(ours), normal_rows(theirs)
    if left == right:
        return None
    only_left, only_right = sorted(set(left) - set(right))[:3], sorted(set(right) - set(left))[:3]
    return f"{len(left)} and {len(right)} rows; only Spark {only_left}; only DuckDB {only_right}"


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or CHECKS:
        started = time.time()
        try:
            found = difference(spark, connection, sf_dir, name)
        except Exception as error:  # a report line per query, also for those that break
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name}: {'ok' if found is None else found} ({time.time() - started:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
