"""Run registered queries and their SQL on the same tables and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v):
    if v is None or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if v != v else repr(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return cell(v.item())
    return str(v)


def rows(frame: pd.DataFrame) -> list[tuple]:
    cols = sorted(frame.columns)
    return sorted(tuple(cell(v) for v in row) for row in frame[cols].itertuples(index=False, name=None))


def compare(spark, con, sf: str, build, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    got = build(spark, sf).toPandas()
    t1 = time.time()
    want = con.execute(sql).df()
    t2 = time.time()
    timing = f"spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s rows {len(got)}"
    if sorted(got.columns) != sorted(want.columns):
        return False, f"{timing} columns {sorted(got.columns)} vs {sorted(want.columns)}"
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind}
    a, b = rows(got), rows(want)
    if a == b:
        return True, f"{timing} {kinds or ''}"
    sa, sb = set(a), set(b)
    only_a, only_b = sorted(sa - sb), sorted(sb - sa)
    detail = f"{timing} {len(a)} vs {len(b)} rows, {len(only_a)}/{len(only_b)} differ"
    cols = sorted(got.columns)
    if only_a and only_b:
        bad = [c for c, x, y in zip(cols, only_a[0], only_b[0]) if x != y]
        detail += f"\n   cols {bad}\n   spark {only_a[0]}\n   sql   {only_b[0]}"
    else:
        detail += f"\n   spark {only_a[:1]}\n   sql   {only_b[:1]}"
    return False, detail


def main() -> None:
    import pathlib

    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from quantloom.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), connect(sf)
    bad = 0
    for n in names:
        sql = entry.oracle_sql().get(n)
        try:
            if sql is None:
                t = time.time()
                k = entry.queries()[n](spark, sf).count()
                print(f"rows  {n} {k} {time.time() - t:.1f}s", flush=True)
                continue
            ok, text = compare(spark, con, sf, entry.queries()[n], sql)
        except Exception as e:
            ok, text = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok   ' if ok else 'FAIL '} {n} {text}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
