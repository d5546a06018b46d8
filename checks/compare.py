"""Run every query against its SQL: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .oracle import oracle_sql
from .queries import queries


def session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallycart-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # many small plans
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("CHECKS_SCRATCH", os.path.abspath("spark-warehouse/_checkpoint")))
        .getOrCreate()
    )


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]


def sql_rows(db, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(row[i] for i in order) for row in cursor.fetchall()]


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(left: list[tuple], right: list[tuple], limit: int = 3) -> list[str]:
    """Rows that differ; values and Python types must be equal."""
    if len(left) != len(right):
        return [f"{len(left)} rows against {len(right)}"]
    out = []
    for a, b in zip(sorted(left, key=_key), sorted(right, key=_key)):
        same = all(type(x) is type(y) and (x == y or (isinstance(x, float) and math.isnan(x) and math.isnan(y))) for x, y in zip(a, b))
        if not same:
            out.append(f"{a} against {b}")
            if len(out) == limit:
                break
    return out


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark, db = session(), connection(folder)
    spark.sparkContext.setLogLevel("ERROR")
    sql, failed = oracle_sql(), 0
    for name, query in queries().items():
        if args and name not in args:
            continue
        began = time.time()
        try:
            names, rows = spark_rows(query(spark, folder))
            took = time.time() - began
            if name not in sql:
                print(f"rows  {name}: {len(rows)} rows, {took:.1f}s {rows[:2]}")
                continue
            expected_names, expected = sql_rows(db, sql[name])
            problems = [f"columns {names} against {expected_names}"] if names != expected_names else differences(rows, expected)
        except Exception as error:  # report and go on
            problems, took, rows = [str(error)[:1500]], time.time() - began, []
        failed += bool(problems)
        print(f"{'FAIL ' if problems else 'ok   '} {name}: {len(rows)} rows, {took:.1f}s", *problems, sep="\n      ", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
