"""Run a registered query and its checking SQL over one folder and compare all rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb


from ledgerline.starmart import oracle
from ledgerline.starmart import queries as registered
from ledgerline.starmart.mapping import STAR_SCHEMAS

QUERIES = registered.queries()
ORACLE = oracle.oracle_sql()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect(config={"memory_limit": "8GB"})
    for name in STAR_SCHEMAS:
        path = f"{folder}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return connection


def differences(spark, connection, folder: str, name: str) -> tuple[int, list, list]:
    """Row count, and the rows only Spark and only the checking SQL has."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    spark_rows = Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    listed = ", ".join(f'"{column}"' for column in columns)
    result = connection.execute(f"SELECT {listed} FROM ({ORACLE[name]}) AS expected")
    expected = Counter(result.fetchall())
    assert sorted(connection.execute(f"DESCRIBE {ORACLE[name]}").df()["column_name"]) == columns
    only_spark, only_sql = spark_rows - expected, expected - spark_rows
    return sum(expected.values()), sorted(only_spark, key=str)[:3], sorted(only_sql, key=str)[:3]
