"""Comparison of registered queries with their SQL on DuckDB.

Run ``python -m tests.oracle [folder] [query ...]`` for a report, with
``PLAIN_SESSION=1`` on a session that has none of this package's defaults.
"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r]
    )


def compare(spark, con, folder, fn, sql):
    """None when both results are equal, else a short description."""
    df = fn(spark, folder)
    spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    sql_rows = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows against {len(sql_rows)}"
    for a, b in zip(spark_rows, sql_rows):
        if a != b:
            return f"{a!r:.600} against {b!r:.600}"
        kinds = [(type(x).__name__, type(y).__name__) for x, y in zip(a, b) if type(x) is not type(y)]
        if kinds:
            return f"types differ: {kinds}"
    return None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from sheafline import build_session
    from sheafline.plans import catalog

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if os.environ.get("PLAIN_SESSION"):
        builder = SparkSession.builder.master("local[8]")
        for key, value in quiet.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session(
            "oracle", "local[8]",
            **{**quiet, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
        )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, fn in catalog.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        sql = catalog.oracle_sql().get(name)
        started = time.time()
        try:
            if sql is None:
                problem = None if fn(spark, folder).count() else "no rows"
            else:
                problem = compare(spark, con, folder, fn, sql)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:26}{time.time() - started:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
