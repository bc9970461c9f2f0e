"""Run queries and their oracles side by side: ``python tests/oracle.py [folder] [name part ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def rows(columns: list[str], data: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else a short description."""
    got_data = [tuple(row) for row in df.collect()]
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = rows(df.columns, got_data), rows(columns, cursor.fetchall())
    if got == want:
        return None if got else "no rows on either side"
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; {sorted(columns)} only spark "
        f"{list(extra)[:3]} ({sum(extra.values())}); only oracle {list(missing)[:3]} ({sum(missing.values())})"
    )


SAME_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_notes(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Columns whose types differ; the values may still be the same."""
    oracle = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: {t} / {oracle.get(c)}" for c, t in df.dtypes if SAME_TYPE.get(t, t) != oracle.get(c)]


def main() -> int:
    from lumbung import workload
    from lumbung.session import get_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_session(**{"spark.master": "local[8]", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for name, run in workload.QUERIES.items():
        if args and not any(a in name for a in args):
            continue
        start, notes = time.time(), []
        try:
            df = run(spark, folder)
            problem = difference(df, con, workload.ORACLES[name])
            notes = type_notes(df, con, workload.ORACLES[name])
        except Exception as error:  # keep going: one report for all queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''} {notes or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
