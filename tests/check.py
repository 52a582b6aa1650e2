"""Compares registered queries with DuckDB. Usage: python tests/check.py [sf] [name ...]"""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/sf{sf}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "\0null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None):
        return str(v.replace(tzinfo=None))
    if hasattr(v, "quantize"):
        return repr(round(float(v), 6))
    return str(v)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows under the same names."""
    cur = con.execute(sql)
    want = _table([d[0] for d in cur.description], cur.fetchall())
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}: {got[1][:2]} / {want[1][:2]}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} of {len(got[1])} rows differ: {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from creditecho.session import build_session

    sf = argv[0] if argv else "0.01"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf), []
    runs, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in runs if not argv[1:] or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv[1:])]
    for name in names:
        start = time.time()
        try:
            df = runs[name](spark, f"{DATA}/sf{sf}")
            if name in sqls:
                note = difference(df, con, sqls[name])
            else:
                n = len(df.collect())
                note = None if n else "no rows"
        except Exception as e:  # report and go on
            note = f"{type(e).__name__}: {str(e)[:400]}"
        spent = time.time() - start
        if note or spent > 6 or len(argv) > 1:
            print(f"{'FAIL' if note else 'ok'} {name} {spent:.1f}s {'' if name in sqls else '(rows only)'} {note or ''}", flush=True)
        if note:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} pass; failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
