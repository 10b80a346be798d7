"""Compare registered queries with their SQL: rows, column types, values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return "\0" if value is None else str(value)


def _canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL result; empty if nothing."""
    found = []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(names) != sorted(df.columns):
        return [f"columns: {sorted(set(names) ^ set(df.columns))}"]
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} / {kinds[name]}")
    rows = [tuple(r) for r in df.collect()]
    if len(rows) != len(expected):
        found.append(f"rows: {len(rows)} / {len(expected)}")
    a, b = _canonical(rows, df.columns), _canonical(expected, names)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        found.append(f"values: spark only {only_a} sql only {only_b}")
    return found


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from almoner.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", settings={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    wanted = sys.argv[1:]
    queries, oracle = entry.queries(), entry.oracle_sql()
    print(len(queries), "queries,", len(oracle), "with SQL; unmatched:", sorted(set(queries) ^ set(oracle)))
    bad = 0
    for name, run in queries.items():
        if name not in (wanted or oracle) or name not in oracle:
            continue
        start = time.time()
        try:
            found = differences(run(spark, folder), con, oracle[name])
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, flush=True)
    print("failed:", bad)
