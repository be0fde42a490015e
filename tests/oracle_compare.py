"""Compare registered Spark queries with their DuckDB oracle texts.

Usage: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
Row count, column names and an order-insensitive comparison of the values
(doubles to 9 significant digits, timestamps without zone) must all agree.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, f"{v:.9g}")
    if hasattr(v, "isoformat"):
        s = v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
        return (1, s.replace("+00:00", ""))
    if hasattr(v, "asDict"):
        return (1, repr(sorted(v.asDict(recursive=True).items())))
    if isinstance(v, (list, tuple)):
        return (1, repr([_norm(x) for x in v]))
    if isinstance(v, bool):
        return (1, str(v))
    if hasattr(v, "as_integer_ratio") or isinstance(v, int):
        try:
            f = float(v)
            if f == int(f) and abs(f) < 2 ** 53:
                return (1, str(int(f)))
            return (1, f"{f:.9g}")
        except (TypeError, ValueError, OverflowError):
            pass
    return (1, str(v))


def compare(spark, con, key: str, spark_df, sql: str) -> dict:
    t0 = time.time()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted(tuple(_norm(r[i]) for i in order) for r in s_rows)
    d_norm = sorted(tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows)
    out["match"] = s_norm == d_norm
    if not out["match"]:
        names = [s_cols[i] for i in order]
        only_s = [r for r in s_norm if r not in set(d_norm)][:3]
        only_d = [r for r in d_norm if r not in set(s_norm)][:3]
        out["columns"] = names
        out["only_spark"] = [[x[1] for x in r] for r in only_s]
        out["only_oracle"] = [[x[1] for x in r] for r in only_d]
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from memberpulse.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    extra = dict(kv.split("=", 1) for kv in os.environ.get("ORACLE_SPARK_CONF", "").split(";") if kv)
    spark = get_session("local[8]", shuffle_partitions=8, conf=extra)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        if key not in oracle:
            df = qs[key](spark, sf_dir)
            print({"key": key, "rows_only": df.count()})
            continue
        r = compare(spark, con, key, qs[key](spark, sf_dir), oracle[key])
        bad += not r["match"]
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
