"""Compare Spark results with DuckDB results on the same parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def canonical(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), sorted_rows(names, cur.fetchall())


def type_differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, map(str, rel.types)))
    return [
        f"{name}: {kind} against {duck.get(name)}"
        for name, kind in df.dtypes
        if SPARK_TYPES.get(duck.get(name)) != kind
    ]
