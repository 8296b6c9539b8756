"""Compare queries with their SQL, or time them: python tests/oracle.py [--dir D] NAME..."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return tuple(normal(x) for x in (v.tolist() if hasattr(v, "tolist") else v))
    if isinstance(v, dict):
        return tuple((k, normal(x)) for k, x in v.items())
    return v


def sql_rows(sql: str, d: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(d)):
        p = f"{d}/{f}/*.parquet" if os.path.isdir(f"{d}/{f}") else f"{d}/{f}"
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{p}'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), [tuple(normal(r[i]) for i in order) for r in cur.fetchall()]


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(normal(x.asDict(True) if hasattr(x, "asDict") else x) for x in r) for r in df.select(*names).collect()]


def differences(df, sql: str, d: str) -> str:
    from collections import Counter

    (a, x), (b, y) = spark_rows(df), sql_rows(sql, d)
    if a != b:
        return f"columns {a} and {b}"
    x, y = Counter(map(repr, x)), Counter(map(repr, y))
    return "" if x == y else f"only Spark: {sum((x - y).values())} {list((x - y))[:3]}; only SQL: {sum((y - x).values())} {list((y - x))[:3]}; both {sum((x & y).values())}"


def main() -> None:
    import __spark_entry__ as e
    from loomstead.session import local_session

    args = sys.argv[1:]
    d = "/root/testdata/sf0.01"
    if args[:1] == ["--dir"]:
        d, args = args[1], args[2:]
    q, s = e.queries(), e.oracle_sql()
    spark = local_session()
    bad = 0
    for name in args or q:
        t = time.time()
        try:
            df = q[name](spark, d)
            said = differences(df, s[name], d) if name in s else f"rows {df.count()} (no SQL)"
            bad += bool(said) and name in s
            print(f"{name}: {time.time() - t:.1f} s {said or 'same'}", flush=True)
        except Exception as x:
            bad += 1
            print(f"{name}: FAILED {type(x).__name__} {str(x)[:700]}", flush=True)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
