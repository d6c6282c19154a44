"""Comparison of a Spark result with its SQL oracle."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "boolean": "BOOLEAN"}


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.date().isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


def differences(df, con, sql: str, limit: int = 4) -> list[str]:
    """Human-readable differences; empty when schema and all values agree exactly."""
    found = []
    relation = con.sql(sql)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema}
    oracle_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != oracle_types:
        found.append(f"schema {sorted(spark_types.items() ^ oracle_types.items())}")
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return found + ["different columns"]
    left = sorted(tuple(_cell(row[c]) for c in columns) for row in df.collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    right = sorted(tuple(_cell(v) for v in row)
                   for row in con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        found.append(f"values {columns}: {only_left[:limit]} vs {only_right[:limit]} "
                     f"({len(only_left)}/{len(only_right)})")
    return found
