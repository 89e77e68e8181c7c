"""Run registered queries against DuckDB: python -m tests.compare [sf] [query ...]"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[int, str | None]:
    """(rows, None) when equal, otherwise (rows, what differs)."""
    frame = query(spark, sf_dir)
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.sql(sql)
    theirs = rows_of(result.columns, result.fetchall())
    if sorted(frame.columns) != sorted(result.columns):
        return len(mine), f"columns {sorted(frame.columns)} and {sorted(result.columns)}"
    if len(mine) != len(theirs):
        return len(mine), f"{len(mine)} and {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return len(mine), f"{str(a)[:600]}\n      and {str(b)[:600]}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    spark_types = {c: names.get(t, t) for c, t in frame.dtypes}
    other = {c: str(t) for c, t in zip(result.columns, result.types)}
    return len(mine), None if spark_types == other else f"types {spark_types} and {other}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            n, problem = compare(spark, con, folder, e.queries()[name], e.oracle_sql()[name])
        except Exception as x:
            n, problem = -1, f"{type(x).__name__}: {str(x)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")
