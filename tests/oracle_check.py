"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH with row counts.
"""

from __future__ import annotations

import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

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
        return round(v, 6)   # strict: -0.0 and 0.0 stay distinct in the sort
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir, key, fn, sql, con):
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = rows_of([r.asDict() for r in sdf.collect()], s_cols)
    if sql is None:
        return "NO-ORACLE", len(s_rows), None, []
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    if d_cols != s_cols:
        return "SCHEMA", len(s_rows), None, [("spark", s_cols), ("duck", d_cols)]
    d_recs = [dict(zip(rel.columns, t)) for t in rel.fetchall()]
    d_rows = rows_of(d_recs, d_cols)
    if len(d_rows) != len(s_rows):
        return "COUNT", len(s_rows), len(d_rows), []
    diffs = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    return ("OK" if not diffs else "VALUES"), len(s_rows), len(d_rows), diffs[:3]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from tidemark.session import get_session

    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if only and key not in only:
            continue
        try:
            status, ns, nd, diffs = compare(spark, sf_dir, key, fn, sqls.get(key), con)
        except Exception as e:  # report and continue
            status, ns, nd, diffs = "ERROR", None, None, [repr(e)[:400]]
        bad += status not in ("OK", "NO-ORACLE")
        print(f"{status:9s} {key:32s} spark={ns} duck={nd}", flush=True)
        for d in diffs:
            print("    ", d, flush=True)
    print(f"done, {bad} failing", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
