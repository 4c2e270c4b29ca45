"""Run queries and their SQL twins on the same files and compare the rows.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    return value


def _kind(value) -> str:
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def check(con, spark, sf_dir, name, fn, sql) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = f"{time.time() - start:.2f}s"
    if sql is None:
        return True, f"{took} rows={len(got)} (no SQL)"
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return False, f"{took} columns {columns} != {want_columns}"
    if got == want:
        if got and [_kind(v) for v in got[0]] != [_kind(v) for v in want[0]]:
            return False, f"{took} types {got[0]} {want[0]}"
        return True, f"{took} rows={len(got)}"
    only = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
    return False, f"{took} {len(got)} vs {len(want)} rows; spark only {only[0]}; sql only {only[1]}"


def main(argv):
    from tests.conftest import make_session

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    chosen = argv[1:] or list(entry.queries())
    bad = 0
    for name in chosen:
        try:
            ok, note = check(con, spark, sf_dir, name, entry.queries()[name],
                             entry.oracle_sql().get(name))
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + name, note, flush=True)
    print(f"{len(chosen) - bad}/{len(chosen)} good")


if __name__ == "__main__":
    main(sys.argv[1:])
