"""Order-insensitive comparison of a Spark result with a DuckDB query."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("STRICT") else f"{v:.9g}"
    if v is None:
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(df, con, sql):
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols), (sorted(df.columns), sorted(ocols))
    assert len(srows) == len(orows)
    hs, ls = rows_digest(df.columns, srows)
    ho, lo = rows_digest(ocols, orows)
    if hs != ho:
        only_s = sorted(set(ls) - set(lo))[:3]
        only_o = sorted(set(lo) - set(ls))[:3]
        raise AssertionError(f"values differ: spark-only {only_s} oracle-only {only_o}")
