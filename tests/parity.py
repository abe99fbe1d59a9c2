"""Compare registered queries with their SQL on one data folder: ``python tests/parity.py DIR [names]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return value if isinstance(value, (list, tuple)) else str(value)


def table(columns, rows):
    """Column names and rows in an order-free, type-aware form."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r))
    )


# Spark type -> SQL type it must meet.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "array<double>": "DOUBLE[]",
}


def differences(df, con, sql) -> str:
    """Empty when types, names and values agree, else what differs first."""
    relation = con.sql(sql)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != sql_types:
        gap = sorted(set(spark_types.items()) ^ set(sql_types.items()), key=str)
        return f"types: {gap}"
    names, left = table(df.columns, df.collect())
    _, right = table(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, columns {names}, first {bad[0]}" if bad else ""


def main(sf_dir: str, wanted: list[str]) -> int:
    from wearline.workspace import session

    spark = session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        df = query(spark, sf_dir)
        if name in sql:
            problem = differences(df, con, sql[name])
        else:
            problem = "" if df.count() > 0 else "no rows"
        failed += bool(problem)
        kind = "V" if name in sql else "R"
        print(f"{kind} {name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
