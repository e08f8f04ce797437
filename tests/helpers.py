"""Shared test helpers: DuckDB views over driver tables, multiset comparison."""

from __future__ import annotations

import hashlib
import os

import duckdb

from tidepool.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if v != v else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_key(rows, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in rows)


def digest(rows, cols) -> str:
    hs = sorted(hashlib.md5("|".join(_norm(r[c]) for c in cols).encode()).hexdigest() for r in rows)
    return hashlib.md5("".join(hs).encode()).hexdigest()


def compare_with_sql(df, con, sql):
    """Assert equal column names, row count and value multiset."""
    srows = [r.asDict() for r in df.collect()]
    rel = con.sql(sql)
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    cols = sorted(df.columns)
    assert digest(srows, cols) == digest(orows, cols)
