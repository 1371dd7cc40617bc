"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


STRICT = os.environ.get("ORACLE_LOOSE") != "1"  # exact floats unless asked otherwise


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    spark_sec = time.time() - t
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    idx = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
    if idx is None:
        return False, f"columns differ: spark={cols} duck={sorted(dcols)}", spark_sec
    drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    srows.sort(key=key)
    drows.sort(key=key)
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} duck={len(drows)}", spark_sec
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[0]}", spark_sec
    return True, f"{len(srows)} rows", spark_sec


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failed = 0
    for name in names:
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:32s} rows-only {n}")
            continue
        try:
            ok, msg, sec = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            ok, msg, sec = False, f"ERROR {type(e).__name__}: {str(e)[:300]}", 0.0
        failed += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {sec:6.2f}s {msg}")
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
