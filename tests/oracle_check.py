"""Compare every registered query with its SQL on DuckDB; run as a script with a folder."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if (Path(sf_dir) / f"{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
            )
    return connection


def compare(spark_rows, spark_columns, relation) -> str | None:
    """None if the rows are the same multiset, else what differs."""
    if sorted(spark_columns) != sorted(relation.columns):
        return f"columns {sorted(spark_columns)} != {sorted(relation.columns)}"
    order = sorted(range(len(spark_columns)), key=lambda i: spark_columns[i])
    duck_order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    ours = sorted(repr(tuple(row[i] for i in order)) for row in spark_rows)
    theirs = sorted(repr(tuple(row[i] for i in duck_order)) for row in relation.fetchall())
    if ours == theirs:
        return None
    only_ours = next((row for row in ours if row not in set(theirs)), None)
    only_theirs = next((row for row in theirs if row not in set(ours)), None)
    return f"{len(ours)} vs {len(theirs)} rows; ours {only_ours}; theirs {only_theirs}"


def check(spark, sf_dir: str, names=None) -> dict[str, str | None]:
    import __spark_entry__ as driver

    connection, statements = duck(sf_dir), driver.oracle_sql()
    results = {}
    for name, query in driver.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        df = query(spark, sf_dir)
        rows = df.collect()
        seconds = time.time() - started
        if name not in statements:
            results[name] = None
            print(f"{name}: {len(rows)} rows, no SQL, {seconds:.1f} s", flush=True)
            continue
        results[name] = compare(rows, df.columns, connection.sql(statements[name]))
        print(f"{name}: {len(rows)} rows, {results[name] or 'same'}, {seconds:.1f} s", flush=True)
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    different = {k: v for k, v in check(session, sys.argv[1], sys.argv[2:]).items() if v}
    sys.exit(1 if different else 0)
