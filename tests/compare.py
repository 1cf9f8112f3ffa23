"""Compare a Spark result with a DuckDB oracle, order-insensitively.

Columns are matched by name; doubles are rounded; rows are sorted as text.
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from railyard.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, digits):.{digits}f}"
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, digits) for x in v) + "]"
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def canon(cols, rows, digits=6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(_norm(r[i], digits) for i in order) for r in rows)
    return [cols[i] for i in order], out


def compare(df, con, sql: str, digits: int = 6):
    """Return (ok, message)."""
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    sc, sr = canon(sc, sr, digits)
    dc, dr = canon(dc, dr, digits)
    if sc != dc:
        return False, f"columns differ: spark={sc} oracle={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} oracle={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ, first: {diff}"
    return True, f"{len(sr)} rows match"
