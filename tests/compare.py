"""Spark query against check SQL: same columns, same rows, order aside."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9) + 0.0
    return str(value) if isinstance(value, float) else value


def compare(spark_df, connection, sql: str) -> str:
    """Empty if both agree, else what differs."""
    cursor = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(types)
    if names != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {names}"
    spot = {d[0]: i for i, d in enumerate(cursor.description)}
    theirs = Counter(tuple(plain(r[spot[n]]) for n in names) for r in cursor.fetchall())
    ours = Counter(tuple(plain(r[n]) for n in names) for r in spark_df.collect())
    if ours != theirs:
        only = [list((a - b).elements()) for a, b in ((ours, theirs), (theirs, ours))]
        return (
            f"{names}: {sum(ours.values())} vs {sum(theirs.values())} rows, "
            f"{len(only[0])} / {len(only[1])} without partner: "
            f"{sorted(map(repr, only[0]))[:2]} {sorted(map(repr, only[1]))[:2]}"
        )
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE",
    }
    odd = [
        (n, t, types[n])
        for n, t in spark_df.dtypes
        if types[n] != kinds.get(t, t) and types[n] not in ("STRING", "NUMBER", "bool")
    ]
    return f"types {odd}" if odd else ""
