"""Runs a query and its SQL side by side and compares the rows. ``python tests/compare.py DIR NAME...``"""

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def duck(d: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(d)):
        path = f"{d}/{f}" if os.path.isfile(f"{d}/{f}") else f"{d}/{f}/*.parquet"
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, name, query, sql, d):
    t = time.time()
    df = query(spark, d)
    names = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in names]).collect())
    took = time.time() - t
    t = time.time()
    cols = {c.lower(): c for c in [x[0] for x in con.execute(f"DESCRIBE {sql}").fetchall()]}
    assert sorted(cols.values()) == names, (name, sorted(cols.values()), names)
    want = Counter(tuple(map(plain, r)) for r in con.execute("SELECT " + ", ".join(f'"{c}"' for c in names) + f" FROM ({sql})").fetchall())
    return names, got, want, took, time.time() - t


if __name__ == "__main__":
    import __spark_entry__ as entry
    from cartolux.runtime import session

    spark = session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    d, wanted = sys.argv[1], sys.argv[2:]
    con, queries, sqls = duck(d), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            if name not in sqls:
                t = time.time()
                n = queries[name](spark, d).count()
                print(f"----  {name}: {n} rows, {time.time() - t:.1f} s, no SQL", flush=True)
                continue
            names, got, want, a, b = compare(spark, con, name, queries[name], sqls[name], d)
            ok = got == want
            bad += not ok
            print(f"{'ok  ' if ok else 'DIFF'}  {name}: {sum(got.values())} rows, {a:.1f} s, SQL {sum(want.values())} rows {b:.1f} s", flush=True)
            if not ok:
                print("   ", names, "\n    only Spark", list((got - want).items())[:4], "\n    only SQL", list((want - got).items())[:4])
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:700]}", flush=True)
    print("bad:", bad)
