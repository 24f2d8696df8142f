"""Compare the registered queries with their SQL: python -m checks.compare [sf_dir] [name ...]."""

import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLE_SQL
from checks.queries import QUERIES
from delayworks.scratch import set_scratch


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = connection.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(row) for row in df.collect()]


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name, sorted."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    sql_columns, expected = sql_rows(sf_dir, ORACLE_SQL[name])
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} != {sorted(sql_columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    pairs = zip(normalised(columns, rows), normalised(sql_columns, expected))
    unequal = [(a, b) for a, b in pairs if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    set_scratch(spark, tempfile.mkdtemp(prefix="compare-"))
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        found = differences(spark, sf_dir, name)
        failed += found is not None
        print(f"{name}: {found or 'same'} ({time.time() - start:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
