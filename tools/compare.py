"""Run registered queries on Spark and their oracle SQL on DuckDB and compare rows.

    python tools/compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def compare(spark, con, name, fn, oracle, sf_dir):
    start = time.time()
    df = fn(spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if oracle is None:
        return f"rows {len(rows)}", took, len(rows) > 0
    cur = con.execute(oracle)
    names = [c[0] for c in cur.description]
    want_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} vs {sorted(names)}", took, False
    pick = [df.columns.index(n) for n in sorted(names)]
    pick2 = [names.index(n) for n in sorted(names)]
    got = Counter(tuple(plain(r[i]) for i in pick) for r in rows)
    want = Counter(tuple(plain(r[i]) for i in pick2) for r in want_rows)
    kinds = {n: (type(a).__name__, type(b).__name__) for n, a, b in zip(
        sorted(names), [next((r[i] for r in rows if r[i] is not None), None) for i in pick],
        [next((r[i] for r in want_rows if r[i] is not None), None) for i in pick2])}
    odd = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if got != want:
        return (f"DIFF spark {len(rows)} oracle {len(want_rows)} cols {sorted(names)}\n   only spark "
                f"{list((got - want).items())[:3]}\n   only oracle {list((want - got).items())[:3]}"), took, False
    return f"ok {len(rows)}" + (f" TYPES {odd}" if odd else ""), took, not odd and len(rows) > 0


def main():
    from bureaulake import queries as registry
    from bureaulake.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    bad = []
    for name in args or queries:
        try:
            text, took, good = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next key
            text, took, good = f"ERROR {str(error)[:600]}", 0.0, False
        if not good:
            bad.append(name)
        print(f"{'  ' if good else '!!'} {name} {took:.1f}s {text}", flush=True)
    print(f"{len(args or queries)} run, {len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
