"""Run registered queries in Spark and their SQL twins in DuckDB and compare the rows, columns by name."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect())


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())


def difference(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None when both sides agree, otherwise a short description of how they differ."""
    df = fn(spark, sf_dir)
    names, left = spark_rows(df)
    other, right = oracle_rows(con, sql)
    if names != other:
        return f"columns {names} vs {other}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"rows {sum(left.values())} vs {sum(right.values())}; only Spark {sum(only_left.values())}: "
            f"{str(list(only_left)[:2])[:500]}; only SQL {sum(only_right.values())}: {str(list(only_right)[:2])[:500]}"
        )
    kinds = spark_kinds(df), oracle_kinds(con, sql)
    return None if kinds[0] == kinds[1] else f"types {kinds[0]} vs {kinds[1]}"


def spark_kinds(df) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def oracle_kinds(con, sql: str) -> dict[str, str]:
    names = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}
    return {r[0]: names.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from loglathe.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    session = local_session(8)
    connection = oracle_connection(folder)
    sql_of = oracle_sql()
    failed = []
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            verdict = difference(session, connection, folder, fn, sql_of[name]) if name in sql_of else "no SQL"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {time.time() - started:.1f}s {verdict or ''}", flush=True)
        if verdict:
            failed.append(name)
    print("failed:", failed)
