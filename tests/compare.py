"""Run a Spark frame and an oracle query and compare them as multisets of rows."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from shelfmark.fixtures.derived import SOURCES


def catalogue(named: dict) -> dict:
    """Without the training-data queries, which have tests of their own."""
    return {k: v for k, v in named.items() if k != "pipeline" and not re.match(r"op\d+_", k)}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in SOURCES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "tinyint": "TINYINT", "smallint": "SMALLINT",
}


def differences(df: DataFrame, con, sql: str, limit: int = 3) -> str:
    """Empty when both sides agree in columns, types and rows."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    theirs = rows(names, answer.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if KINDS.get(k, k).lower() != kinds[c].lower()}
    ours = rows(df.columns, df.collect())
    if ours == theirs:
        return f"types {wrong}" if wrong else ""
    return (
        f"rows {sum(ours.values())} vs {sum(theirs.values())}; only spark {list((ours - theirs).items())[:limit]};"
        f" only oracle {list((theirs - ours).items())[:limit]} {wrong or ''}"
    )
