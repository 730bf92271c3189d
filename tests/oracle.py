"""Compares a Spark result with the SQL result of the same name."""

import math
from datetime import date, datetime

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], list[str]]:
    names = sorted(df.columns)
    rows = [repr([_plain(row[name]) for name in names]) for row in df.collect()]
    return names, sorted(rows)


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str]]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    names = sorted(columns)
    at = [columns.index(name) for name in names]
    rows = [repr([_plain(row[i]) for i in at]) for row in result.fetchall()]
    return names, sorted(rows)
