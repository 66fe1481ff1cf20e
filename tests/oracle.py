"""Run a registered query and its SQL twin and compare the values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dict):
        return sorted((str(k), _norm(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return [_norm(v) for v in value]
    if hasattr(value, "asDict"):
        return _norm(value.asDict())
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((repr([_norm(r[c]) for c in cols]) for r in df.collect()))


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(repr([_norm(r[i]) for i in at]) for r in cur.fetchall())


def compare(df, con, sql):
    """None when equal, otherwise a short description of the difference."""
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return f"columns differ: {sc} vs {dc}"
    if len(sr) != len(dr):
        only_s, only_d = list(set(sr) - set(dr))[:2], list(set(dr) - set(sr))[:2]
        return f"row counts differ: {len(sr)} vs {len(dr)}\n  spark {only_s}\n  duck  {only_d}"
    if sr != dr:
        a, b = sorted(set(sr) - set(dr)), sorted(set(dr) - set(sr))
        return f"{len(a)} of {len(sr)} rows differ; {sc}\n  spark {a[:2]}\n  duck  {b[:2]}"
    return None
