"""Compare every catalogue query with its oracle: columns, types, rows, values."""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def connect(directory):
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark_df, con, sql):
    """Empty text when equal, else the first difference."""
    columns = sorted(spark_df.columns)
    relation = con.sql(sql)
    if columns != sorted(relation.columns):
        return f"columns: {columns} vs {sorted(relation.columns)}"
    found = dict(zip(relation.columns, [str(t) for t in relation.types]))
    for name, kind in spark_df.dtypes:
        if DUCK_TYPES.get(kind) != found[name]:
            return f"type of {name}: {kind} vs {found[name]}"
    order = ", ".join(f'"{c}"' for c in columns)
    mine = sorted((tuple(r) for r in spark_df.select(*columns).collect()), key=key)
    theirs = sorted(relation.select(order).fetchall(), key=key)
    if len(mine) != len(theirs):
        return f"rows: {len(mine)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ: {bad[:2]}" if bad else ""


def main():
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = make_session(), connect(args.dir)
    runs, oracle = queries(), oracle_sql()
    failed = []
    for name in args.names or list(runs):
        started = time.time()
        try:
            df = runs[name](spark, args.dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                text = problem or "equal"
            else:
                problem, text = "", f"{df.count()} rows (no oracle)"
        except Exception as error:  # report and go on
            problem = text = f"{type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - started:6.1f}s {text}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
