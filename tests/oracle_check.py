"""Run queries() against oracle_sql() on one scale factor and report matches.

    python tests/oracle_check.py [sf_dir] [key ...]
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

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_value(v):
    if v is None:
        return None
    if type(v).__name__ in ("bool_", "bool"):
        return bool(v)
    if isinstance(v, float) or type(v).__name__.startswith("float"):
        v = float(v)
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int) or type(v).__name__.startswith(("int", "uint")):
        return int(v)
    return str(v)


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm_value(None if (isinstance(x, float) and math.isnan(x)) else
                                      (None if x is pd.NaT or (x is not None and not isinstance(x, (list, tuple, dict)) and pd.isna(x)) else x))
                          for x in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, keys=None) -> dict:
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for key in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[key](spark, sf_dir).toPandas()
        except Exception as ex:  # noqa: BLE001
            report[key] = f"SPARK ERROR {str(ex)[:300]}"
            print(key, report[key], flush=True)
            continue
        t1 = time.time()
        if key not in sql:
            report[key] = f"rows-only {len(sdf)}"
            print(key, report[key], f"spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            ddf = con.sql(sql[key]).df()
        except Exception as ex:  # noqa: BLE001
            report[key] = f"DUCK ERROR {str(ex)[:300]}"
            print(key, report[key], flush=True)
            continue
        t2 = time.time()
        if sorted(sdf.columns) != sorted(ddf.columns):
            report[key] = f"COLUMNS spark={sorted(sdf.columns)} duck={sorted(ddf.columns)}"
        elif len(sdf) != len(ddf):
            report[key] = f"ROWCOUNT spark={len(sdf)} duck={len(ddf)}"
        else:
            a, b = canon(sdf), canon(ddf)
            if a == b:
                report[key] = f"OK {len(sdf)}"
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                report[key] = f"VALUES differ e.g. {diff}"
        print(key, report[key][:600], f"spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s", flush=True)
    return report


if __name__ == "__main__":
    from ledgermatch.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    rep = compare(spark, sf, sys.argv[2:] or None)
    ok = sum(1 for v in rep.values() if v.startswith("OK") or v.startswith("rows-only"))
    print(f"{ok}/{len(rep)} ok")
