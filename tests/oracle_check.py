"""Run registered queries in Spark and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        s = str(v)
        return s[:10] if (len(s) == 10 or s.endswith(" 00:00:00")) else s
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir).toPandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    ddf = con.execute(sql).df()
    res["duck_rows"] = len(ddf)
    res["cols_match"] = sorted(sdf.columns) == sorted(ddf.columns)
    if not res["cols_match"]:
        res["only_spark"] = sorted(set(sdf.columns) - set(ddf.columns))
        res["only_duck"] = sorted(set(ddf.columns) - set(sdf.columns))
        return res
    a, b = _rows(sdf), _rows(ddf)
    res["match"] = a == b
    if not res["match"] and len(a) == len(b):
        cols = sorted(sdf.columns)
        bad = {}
        for ra, rb in zip(a, b):
            for c, x, y in zip(cols, ra, rb):
                if x != y:
                    bad.setdefault(c, (x, y))
        res["first_diffs"] = dict(list(bad.items())[:8])
    return res


if __name__ == "__main__":
    from barwright.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark()
    from __spark_entry__ import queries

    con = duck(sf)
    for n in names or list(queries()):
        try:
            print(compare(spark, n, sf, con), flush=True)
        except Exception as e:  # report and continue
            print({"name": n, "error": str(e)[:500]}, flush=True)
