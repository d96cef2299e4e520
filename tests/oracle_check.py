"""Run every registered query against its SQL oracle in DuckDB.

    python tests/oracle_check.py [sf dir] [query ...]
"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def sorted_rows(columns, rows):
    """Rows with columns in name order, as comparable values."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted([repr(tuple(row[index] for index in order)) for row in rows])


def compare(spark, connection, sf_dir, name, query, sql):
    """None if equal, else what differs."""
    frame = query(spark, sf_dir)
    got = [tuple(row) for row in frame.collect()]
    expected = connection.sql(sql)
    columns, rows = expected.columns, expected.fetchall()
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    left, right = sorted_rows(frame.columns, got), sorted_rows(columns, rows)
    if left != right:
        first = next((pair for pair in zip(left, right) if pair[0] != pair[1]), None)
        return f"{len(left)} rows vs {len(right)}; first difference {first}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    connection = oracle_connection(folder)
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name, query, oracle_sql()[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
