"""Run registered queries in Spark and their SQL in DuckDB and compare.

    python tests/compare.py FOLDER [NAME ...]
"""

from __future__ import annotations

import importlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(v)
    if hasattr(v, "item"):
        v = v.item()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((x is not None, str(x)) for x in r))


def difference(spark_df, con, sql) -> tuple[str | None, int]:
    """What is different (None if nothing) and the number of rows."""
    names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} instead of {want_names}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}", len(got)
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} instead of {b}", len(got)
    return None, len(got)


def main() -> None:
    folder, *only = sys.argv[1:]
    from punctua.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    if only and only[0].startswith("queries_"):
        importlib.import_module(f"punctua.plans.{only[0]}")
        from punctua.plans.registry import QUERIES as queries, SQL as oracle

        only = only[1:]
    else:
        entry = importlib.import_module("__spark_entry__")
        queries, oracle = entry.queries(), entry.oracle_sql()
    con, bad = connect(folder), []
    for name in only or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracle:
                problem, n = difference(df, con, oracle[name])
            else:
                problem, n = None, df.count()
        except Exception as error:  # noqa: BLE001  (reported below)
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        kind = "sql " if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok'} {kind} {name} rows={n} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print("different:", bad or "none")


if __name__ == "__main__":
    main()
