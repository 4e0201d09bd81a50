"""Run registered queries and compare them with their SQL on the same tables.

    python tests/check.py [-d DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)
    return sorted(tuple(fix(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Empty string if equal, else what differs."""
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = canon(got, df.columns), canon(want, names)
    if a == b:
        return "", len(a)
    sa, sb = set(a), set(b)
    return (
        f"rows {len(a)} vs {len(b)}; only spark {str(sorted(sa - sb)[:2])[:600]}; "
        f"only sql {str(sorted(sb - sa)[:2])[:600]}",
        len(a),
    )


def main():
    import __spark_entry__ as entry
    from tests.session import session

    ap = argparse.ArgumentParser()
    ap.add_argument("-d", default="/root/testdata/sf0.001")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark, con = session(), duck(args.d)
    q, o = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or q:
        t = time.time()
        try:
            df = q[name](spark, args.d)
            if name in o:
                diff, n = compare(df, con, o[name])
                verdict = "ok" if not diff else f"DIFF {diff}"
            else:
                n = len(df.collect())
                verdict = "rows only"
        except Exception as exc:  # report and go on with the next query
            n, verdict = 0, f"FAIL {type(exc).__name__}: {str(exc)[:900]}"
        bad += verdict[:2] in ("DI", "FA")
        print(f"{name:24s} {n:8d} rows {time.time() - t:6.2f}s  {verdict}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
