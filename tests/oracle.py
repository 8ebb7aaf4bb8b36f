"""Run registered queries against their checking SQL: ``python tests/oracle.py [sf] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else f"{v:.9g}")
    return (type(v).__name__, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """Difference between the Spark rows and the SQL rows, or None."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(got)
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}\n  spark only {only_got}\n  sql only   {only_want}", len(got)
    return None, len(got)


def main(argv):
    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    sf_dir = f"{TESTDATA}/sf{sf}"
    spark, con = session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, queries[name], oracles.get(name))
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        took = time.time() - start
        state = "FAIL" if problem else ("ok" if name in oracles else "rows")
        bad += bool(problem)
        print(f"{state:5} {name:32} {n:8} rows {took:6.2f}s {(problem or '')[:900]}", flush=True)
    print(f"{bad} failing of {len(argv[1:] or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
