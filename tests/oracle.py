"""Runs queries on Spark and their SQL on DuckDB, and compares names, types and rows."""

from __future__ import annotations

import glob
import os
import time

import duckdb
from pyspark.sql import SparkSession

TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((value is not None, str(type(value)), value) if value is not None else (False, "", 0) for value in row))


def compare(spark: SparkSession, connection, name: str, build, sql: str | None, sf_dir: str) -> tuple[str, float]:
    """'ok', 'rows-only' or the first difference; and Spark seconds."""
    started = time.time()
    frame = build(spark, sf_dir)
    columns = sorted(frame.columns)
    mine = [tuple(row[c] for c in columns) for row in frame.select(*columns).collect()]
    seconds = time.time() - started
    if sql is None:
        return f"rows-only ({len(mine)})", seconds
    result = connection.execute(f"SELECT * FROM ({sql})")
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}", seconds
    for field in frame.schema.fields:
        if TYPES.get(field.dataType.simpleString()) != kinds[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}", seconds
    order = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in order) for row in result.fetchall()]
    if len(mine) != len(theirs):
        return f"row count {len(mine)} != {len(theirs)}", seconds
    if not mine:
        return "no rows", seconds
    for left, right in zip(_sorted(mine), _sorted(theirs)):
        if left != right:
            return f"rows differ: {dict(zip(columns, left))} != {dict(zip(columns, right))}", seconds
    return f"ok ({len(mine)})", seconds
