"""Run queries next to their checking SQL in DuckDB and compare them value by value.

    python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemill.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def canonical(columns, rows):
    """Rows as sorted text, with columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        cells = []
        for i in order:
            v = row[i]
            if v is None or v != v:
                cells.append("NULL")
            elif isinstance(v, float):
                cells.append(repr(v) if v != 0 else "0.0")
            else:
                cells.append(f"{type(v).__name__}:{v}" if isinstance(v, bool) else str(v))
        out.append("|".join(cells))
    out.sort()
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--times", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from tidemill.plans import CHECK_SQL, QUERIES
    spark = local_session(8)
    con = duckdb.connect()
    con.sql("set enable_progress_bar=false")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{args.sf}/{t}.parquet'")
    names = []
    for n in args.names or QUERIES:
        names += [q for q in QUERIES if q.startswith(n[:-1])] if n.endswith("*") else [n]
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            got = [tuple(r) for r in df.collect()]
        except Exception as exc:
            bad.append(name)
            print(f"FAIL {name}: {type(exc).__name__} {str(exc)[:900]}", flush=True)
            continue
        t1 = time.time() - t0
        if name not in CHECK_SQL:
            print(f"rows {name}: {len(got)} rows {t1:.1f}s {df.columns}", flush=True)
            if not len(got):
                bad.append(name)
            continue
        try:
            t0 = time.time()
            rel = con.sql(CHECK_SQL[name])
            want = rel.fetchall()
            t2 = time.time() - t0
        except Exception as exc:
            bad.append(name)
            print(f"FAIL {name} SQL: {str(exc)[:900]}", flush=True)
            continue
        if sorted(df.columns) != sorted(rel.columns):
            bad.append(name)
            print(f"FAIL {name}: columns {sorted(df.columns)} vs {sorted(rel.columns)}", flush=True)
            continue
        kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
        pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        types = {c: (t, kinds[c]) for c, t in df.dtypes if pairs.get(t) != kinds[c]}
        for i, (c, t) in enumerate(df.dtypes):
            if t in ("int", "bigint") and any(r[i] is None for r in got):
                types[c] = (t, "has NULL")
        a, b = canonical(df.columns, got), canonical(rel.columns, want)
        if a != b or not a:
            bad.append(name)
            sa, sb = set(a), set(b)
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}; only spark {sorted(sa - sb)[:4]}; "
                  f"only sql {sorted(sb - sa)[:4]}", flush=True)
            continue
        note = f" TYPES {types}" if types else ""
        print(f"ok   {name}: {len(a)} rows spark {t1:.1f}s sql {t2:.1f}s{note}", flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} good; bad: {bad}")


if __name__ == "__main__":
    main()
