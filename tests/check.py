"""Run registered queries against their check SQL: python tests/check.py [name-prefix ...] [--sf 0.01]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


def connect(sf_dir):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "as_tuple"):
        return float(value)
    if isinstance(value, int):
        return value
    return str(value)


def same(a, b):
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def sort_key(row):
    return tuple((v is None, str(type(v).__name__) if isinstance(v, bool) else "", f"{v:.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)) for v in row)


def compare(spark_df, con, sql):
    cols = sorted(spark_df.columns)
    got = [tuple(normal(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(names) != cols:
        return f"columns differ: spark {cols} oracle {sorted(names)}", len(got)
    order = [names.index(c) for c in cols]
    want = [tuple(normal(r[i]) for i in order) for r in rel.fetchall()]
    types = {n: str(t) for n, t in zip(names, rel.types)}
    note = ""
    for c, t in spark_df.dtypes:
        o = types[c]
        ok = {
            "bigint": ["BIGINT"], "int": ["INTEGER"], "double": ["DOUBLE"], "string": ["VARCHAR"],
            "boolean": ["BOOLEAN"], "date": ["DATE"], "timestamp": ["TIMESTAMP"], "float": ["FLOAT"],
        }.get(t)
        if ok is None or o not in ok:
            note += f" [type {c}: {t} vs {o}]"
    if len(got) != len(want):
        return f"row count differs: spark {len(got)} oracle {len(want)}{note}", len(got)
    got.sort(key=sort_key)
    want.sort(key=sort_key)
    for g, w in zip(got, want):
        if not all(same(a, b) for a, b in zip(g, w)):
            return f"values differ:\n  {cols}\n  spark  {g}\n  oracle {w}{note}", len(got)
    return note.strip(), len(got)


def main(argv):
    from waymark.queries import ORACLES, QUERIES, load_all
    from waymark.session import build_session

    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    load_all()
    spark = build_session("8", 8)
    sf_dir = f"{DATA}/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                message, n = compare(df, con, ORACLES[name])
            else:
                n, message = len(df.collect()), ""
                message = "" if n else "no rows"
        except Exception as error:  # report and go on
            message, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        state = "ok" if not message else "BAD"
        bad += state == "BAD"
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{state} {name}{kind} rows={n} {time.time() - start:.1f}s {message}", flush=True)
    print("bad:", bad, "queries:", len(QUERIES), "with check SQL:", len(ORACLES))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
