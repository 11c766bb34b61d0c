"""Rows of a Spark query and of SQL in DuckDB over the same Parquet files, in one comparable form."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, int):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        at = f"{sf_dir}/{t}.parquet"
        if os.path.exists(at):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
