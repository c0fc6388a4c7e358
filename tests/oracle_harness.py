"""Compare a registered Spark query with its DuckDB oracle statement."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

from visitlens.sources.tables import TEST_TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def table_digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return table_digest(df.columns, rows)


def duck_digest(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return table_digest(cols, cur.fetchall())


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    s = spark_digest(query(spark, sf_dir))
    d = duck_digest(con, sql)
    return {"query": name, "rows": (s[0], d[0]), "schema_match": s[1] == d[1],
            "cols": (s[1], d[1]) if s[1] != d[1] else None,
            "value_match": s[2] == d[2]}
