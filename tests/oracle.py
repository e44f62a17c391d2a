"""Compare a Spark result with a DuckDB query over the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    return cols, rows


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], rows


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def compare(df, con, sql: str, rel_tol: float = 0.0):
    """Return (ok, message).  Exact match unless ``rel_tol`` > 0."""
    scols, srows = rows_of_spark(df)
    dcols, drows = rows_of_duck(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count differs: spark={len(srows)} duck={len(drows)}"
    srows.sort(key=_key)
    drows.sort(key=_key)
    for a, b in zip(srows, drows):
        for x, y in zip(a, b):
            if x == y:
                continue
            if rel_tol and isinstance(x, float) and isinstance(y, float):
                if math.isclose(x, y, rel_tol=rel_tol, abs_tol=1e-9):
                    continue
            return False, f"row differs: spark={a} duck={b}"
    return True, f"{len(srows)} rows equal"
