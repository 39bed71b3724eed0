"""Differential check: each registered Spark query vs its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, same value
multiset (order-insensitive), plus a dtype-class check.
Usage: python tests/differential.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def kind(t: str) -> str:
    t = t.lower()
    if "int" in t or t == "long" or t == "bigint":
        return "int"
    if "double" in t or "float" in t or "decimal" in t:
        return "float"
    if "bool" in t:
        return "bool"
    if "date" in t and "time" not in t:
        return "date"
    if "timestamp" in t:
        return "ts"
    return "str"


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only={sorted(set(s_cols) - set(d_cols))} "
                        f"duck-only={sorted(set(d_cols) - set(s_cols))}")
    else:
        bad = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if bad:
            problems.append(f"types differ: {bad}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows differ: spark={len(s_rows)} duck={len(d_rows)}")
        a, b = rows_of(s_cols, s_rows), rows_of(list(d_cols), d_rows)
        if a != b:
            sa, sb = set(a), set(b)
            only_s = sorted(sa - sb)[:3]
            only_d = sorted(sb - sa)[:3]
            problems.append(f"values differ ({len(sa - sb)} / {len(sb - sa)} distinct rows);\n"
                            f"    cols={sorted(s_cols)}\n    spark-only={only_s}\n    duck-only={only_d}")
    status = "OK " if not problems else "BAD"
    print(f"{status} {name}: rows={len(s_rows)} spark={t1 - t0:.1f}s duck={t2 - t1:.2f}s", flush=True)
    for p in problems:
        print("    " + p, flush=True)
    return not problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    wanted = [a for a in argv[1:] if not a.startswith("/")]
    from rollcall.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok = bad = 0
    for name, fn in qs.items():
        if wanted and not any(w in name for w in wanted):
            continue
        if name not in oracle:
            print(f"--  {name}: no oracle (rows-only)")
            continue
        try:
            good = compare(spark, name, fn, oracle[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            good = False
        ok += good
        bad += not good
    print(f"summary: {ok} ok, {bad} bad")
    return 0 if bad == 0 else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
