"""Compare a Spark result with a DuckDB oracle on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    import os
    con.execute(f"SET TimeZone = '{os.environ.get("ORACLE_TZ", "UTC")}'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple("" if x is None else x for x in t))
    return names, out


def spark_rows(df):
    rows = df.collect()
    return df.columns, [tuple(r) for r in rows]


def duckdb_rows(con, sql):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, res.fetchall()


def compare(df, con, sql) -> tuple[bool, str]:
    s_cols, s_rows = canonical_rows(*spark_rows(df))
    d_cols, d_rows = canonical_rows(*duckdb_rows(con, sql))
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row: spark={a} duckdb={b}"
    return True, f"{len(s_rows)} rows equal"
