"""Runs registered queries against DuckDB: ``python tests/oracle.py [folder] [query ...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Spark type names and the DuckDB types they are compared with.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def duck_type(kind: str) -> str:
    if kind.startswith("array<"):
        return duck_type(kind[6:-1]) + "[]"
    return TYPE_NAMES.get(kind, kind.upper())


def plain(value):
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return "nan" if value != 0 else 0.0
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def rows_of(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


# Plan nodes that a query with an SQL counterpart must not need.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def compare(spark, con, query, sql: str, folder: str) -> list[str]:
    """Differences in columns, types, row count and values."""
    df = query(spark, folder)
    relation = con.sql(sql)
    plan = df._jdf.queryExecution().executedPlan().toString()
    problems = [f"plan has {node}" for node in UNWANTED if node in plan]
    ours = {f.name: duck_type(f.dataType.simpleString()) for f in df.schema}
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if ours != theirs:
        problems.append(f"schema {ours} against {theirs}")
    got, want = rows_of(df.columns, df.collect()), rows_of(relation.columns, relation.fetchall())
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    if got != want:
        only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        problems.append(f"{len(only_got)} rows differ: {[r[:300] for r in only_got[:2]]} against {[r[:300] for r in only_want[:2]]}")
    return problems


def main() -> None:
    from caseloom.registry import ORACLES, QUERIES
    from caseloom.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.sql.warehouse.dir": "/tmp/caseloom-warehouse",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problems = compare(spark, con, QUERIES[name], ORACLES[name], folder)
            else:
                rows = QUERIES[name](spark, folder).collect()
                problems = [] if rows else ["no rows"]
                if args:
                    print(*rows[:8], sep="\n")
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(problems)
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {time.time() - start:6.1f}s {name}", *problems, sep="\n      " if problems else " ", flush=True)
    print(f"{bad} of {len(args or QUERIES)} failed")


if __name__ == "__main__":
    main()
