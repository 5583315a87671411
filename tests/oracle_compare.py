"""Run each driver query in Spark and its oracle SQL in DuckDB and compare.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of all values (columns sorted by name).

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.01")))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as entry

    qs = entry.queries()
    sql = entry.oracle_sql()
    con = duckdb_connection(sf_dir)
    out = {}
    for name in names or qs:
        t0 = time.time()
        res = {"oracle": name in sql}
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = _rows(s_cols, [tuple(r) for r in df.collect()])
            res["spark_rows"] = len(s_rows)
            if name in sql:
                cur = con.execute(sql[name])
                d_cols = [d[0] for d in cur.description]
                d_rows = _rows(d_cols, cur.fetchall())
                res["oracle_rows"] = len(d_rows)
                res["columns_match"] = sorted(s_cols) == sorted(d_cols)
                res["values_match"] = s_rows == d_rows
                if not res["values_match"]:
                    diff_s = [r for r in s_rows[:20000] if r not in set(d_rows)][:3]
                    res["sample_spark_only"] = [list(map(str, r)) for r in diff_s]
                    res["columns"] = [sorted(s_cols), sorted(d_cols)]
        except Exception as exc:  # noqa: BLE001 - report and go on
            res["error"] = f"{type(exc).__name__}: {str(exc)[:400]}"
        res["sec"] = round(time.time() - t0, 2)
        out[name] = res
        print(name, json.dumps(res), flush=True)
    return out


if __name__ == "__main__":
    from fraudmart.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    result = compare(spark, sf, sys.argv[2:] or None)
    bad = [n for n, r in result.items() if r.get("error") or (r["oracle"] and not r.get("values_match"))]
    print("FAILED:" if bad else "ALL OK", bad)
