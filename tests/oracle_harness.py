"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if pd.isna(v) if not hasattr(v, "__len__") else False:
        return None
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return sorted((tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries

    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(sp), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    dp = con.execute(sql).fetchdf()
    res["oracle_rows"] = len(dp)
    if sorted(sp.columns) != sorted(dp.columns):
        res["status"] = f"COLUMNS spark={sorted(sp.columns)} oracle={sorted(dp.columns)}"
        return res
    a, b = rows_of(sp), rows_of(dp)
    if a == b:
        res["status"] = "ok"
    else:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["status"] = "MISMATCH"
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_oracle"] = sorted(sb - sa)[:3]
    return res


def main(argv: list[str]) -> int:
    from innsight.session import build_session
    from __spark_entry__ import queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(queries())
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"bad={bad} of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
