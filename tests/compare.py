"""Run registered queries beside their DuckDB twins: python tests/compare.py SF [query ...]"""

import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


def normal(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 9) if not math.isnan(value) else None
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir, name):
    """``(ok, message)`` for one query."""
    from __spark_entry__ import oracle_sql, queries

    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return bool(got), f"{len(got)} rows, no oracle, {took:.1f}s"
    start = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    message = f"{len(got)} rows, spark {took:.1f}s duckdb {time.time() - start:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return False, f"{message}; want {len(want)}; extra {extra}; missing {missing}"
    return True, message


if __name__ == "__main__":
    from crawlflow.session import get_session

    sf, *names = sys.argv[1:]
    session = get_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    from __spark_entry__ import queries

    folder = f"{TESTDATA}/{sf}"
    connection = duck(folder)
    for query_name in names or queries():
        try:
            ok, text = compare(session, connection, folder, query_name)
        except Exception as error:  # shown, then on to the next query
            ok, text = False, repr(error)[:1500]
        print("ok  " if ok else "FAIL", query_name, text[:1500], flush=True)
