"""Compare registered queries with their SQL in DuckDB: rows, columns, values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    if v is None:
        return "null"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def connect(sf: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    got_rows = df.collect()
    got = rows_of(df.columns, got_rows)
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"row counts differ: {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    return ""


def main(sf: str, names):
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from trajloom.session import local_session

    spark = local_session(8)
    con = connect(sf)
    q, o = e.queries(), e.oracle_sql()
    failed = []
    for name in names or q:
        t = time.time()
        try:
            df = q[name](spark, sf)
            if name in o:
                msg = compare(df, con, o[name])
                tail = msg or "equal"
            else:
                n = df.count()
                msg = "" if n else "no rows"
                tail = f"{n} rows (no SQL)"
        except Exception as x:  # noqa: BLE001
            msg = tail = "ERROR " + str(x)[:1500]
        if msg:
            failed.append(name)
        print(f"{'FAIL' if msg else 'ok  '} {name:32s} {time.time() - t:6.2f}s {tail}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
