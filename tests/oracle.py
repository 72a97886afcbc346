"""Run registered queries against their SQL: ``python -m tests.oracle [--sf DIR] [names...]``."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("checks")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if value != value else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder):
    import duckdb
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from '{folder}/{f}'")
    return con


KINDS = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}, "date": {"DATE"}}


def compare(spark, con, name, build, sql, folder):
    """None when equal, else a text that says what differs."""
    df = build(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return "the plan forms pairs without a key"
    got_columns, got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}"
    types = dict((c[0], str(c[1])) for c in con.execute(f"describe {sql}").fetchall())
    odd = [(c, t, types[c]) for c, t in df.dtypes if t in KINDS and types[c] not in KINDS[t]]
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first: {bad[0][0]} != {bad[0][1]} ({got_columns})" if bad else None


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con = session(), duck(args.sf)
    failed = 0
    for name in args.names or queries:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, name, queries[name], oracle[name], args.sf)
            else:
                n = len(queries[name](spark, args.sf).collect())
                problem = None if n else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {'sql ' if name in oracle else 'rows'} {name}"
              + (f": {problem}" if problem else ""), flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
