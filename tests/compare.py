"""Run registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"]
    want = rows_of(names, expected.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(want) != len(got):
        return [f"rows: {len(got)} from Spark, {len(want)} from SQL"]
    bad = [f"{g} <> {w}" for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    return [f"{len(bad)} rows differ, on columns {sorted(names)}", *bad[:3]] if bad else []


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con, sqls = session(), database(folder), entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = differences(df, con, sqls[name]) if name in sqls else [] if df.count() >= 0 else []
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        kind = "sql" if name in sqls else "rows"
        print(f"{'ok  ' if not found else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name}", *found, sep="\n      " if found else " ", flush=True)
